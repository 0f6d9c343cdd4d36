"""Files written by executors to a file system that all of them see, each under its final name only when whole."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame

MODES = ("overwrite", "ignore", "error")


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in uri:
        return fs.LocalFileSystem(), uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def exists(uri: str) -> bool:
    files, at = open_fs(uri)
    return files.get_file_info(at).type != fs.FileType.NotFound


def write_bytes(uri: str, data: bytes, mode: str = "overwrite") -> bool:
    """Writes one file, and its folders; says whether it did. A repeated attempt gives the same file."""
    files, at = open_fs(uri)
    if mode != "overwrite" and files.get_file_info(at).type != fs.FileType.NotFound:
        if mode == "ignore":
            return False
        raise FileExistsError(uri)
    files.create_dir(at.rsplit("/", 1)[0], recursive=True)
    part = f"{at}.{uuid.uuid4().hex}.part"
    with files.open_output_stream(part) as f:
        f.write(data)
    files.move(part, at)
    return True


def write_files(rows: DataFrame, root: str, path: Column, content: Column, mode: str = "ignore") -> DataFrame:
    """(path, written) after writing each row's content to root/path; null content writes nothing.

    This runs when the result is read, and again if it is read again: with mode `ignore` that changes nothing.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [c is not None and write_bytes(f"{root}/{p}", c, mode) for p, c in zip(b.column(0).to_pylist(), (x.as_py() for x in b.column(1)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(done, pa.bool_())], names=["path", "written"])

    return rows.select(path.alias("path"), content.cast("binary").alias("content")).mapInArrow(run, "path string, written boolean")


def copy_files(rows: DataFrame, root: str, source: Column, path: Column) -> DataFrame:
    """(path, written) after copying each row's source file to root/path; a missing source writes nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = []
            for s, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if s is None or not exists(s):
                    done.append(False)
                    continue
                files, at = open_fs(s)
                with files.open_input_stream(at) as f:
                    done.append(write_bytes(f"{root}/{p}", f.read(), "ignore"))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(done, pa.bool_())], names=["path", "written"])

    return rows.select(source.alias("source"), path.alias("path")).mapInArrow(run, "path string, written boolean")


def prepare(root: str, mode: str) -> None:
    """What an output folder's save mode asks for before a run: overwrite empties it, error refuses one with content, ignore leaves it."""
    files, at = open_fs(root)
    info = files.get_file_info(at)
    if mode == "overwrite" and info.type != fs.FileType.NotFound:
        files.delete_dir_contents(at)
    elif mode == "error" and info.type != fs.FileType.NotFound and files.get_file_info(fs.FileSelector(at)):
        raise FileExistsError(root)
    files.create_dir(at, recursive=True)
