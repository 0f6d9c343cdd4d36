"""WARC records in ZIP packages: written from a table of pages, read back by byte ranges.

A package is a ZIP whose members are stored, not compressed: archive/data.warc.gz, one gzip member for each
record, and indexes/index.cdxj, one line for each record with its offset and length in that member. The reader
takes the end of the package, follows the end record (ZIP64 too) to the central directory, locates both members
and then reads single records by their ranges; nothing is extracted.

Pages with equal payloads (SHA-1) of at least min_bytes are written once: the smallest page_id gets the
response record, the others revisit records that refer to it. Only digests that occur twice take part in
that join; they are broadcast after a count, or else shuffled, where Spark splits a skewed digest.

Packages are written to the shared folder under names of their own for each attempt, and only those of
attempts that ended are in the manifest, itself a table there; a repeated task leaves an unused file at worst.

Edge cases. Null html counts as empty. Pages without an id are response records and are never referred to; they
read back with a null id. Rows of one id with equal payloads: if it is the smallest id, each is a
response. Null urls leave out the target header; line breaks in urls are percent-encoded. An empty table
gives no packages and no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from hashlib import sha1
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh_dir, join_small, stored

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Payload bytes in a package, and package bytes that one task reads, about.
PACKAGE_BYTES, RANGE_BYTES = 256 << 20, 16 << 20
#: Payload bytes in a batch that a reader hands over.
_BATCH_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
_URN = "urn:page:"


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in uri:
        return fs.LocalFileSystem(), uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class Member(NamedTuple):
    name: str
    method: int
    size: int
    header: int


def _zip64(extra: bytes, fields: dict[str, int]) -> dict[str, int]:
    """Fields that say 0xffffffff, read from the ZIP64 extra field in its order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            place = at + 4
            for name, value in fields.items():
                if value == 0xFFFFFFFF:
                    if place + 8 > at + 4 + size:
                        raise ValueError("a ZIP64 field is missing")
                    fields[name] = struct.unpack_from("<Q", extra, place)[0]
                    place += 8
        at += 4 + size
    return fields


def directory(read, size: int) -> list[Member]:
    """The members of a ZIP of so many bytes, by its central directory; read(offset, n) gives bytes."""
    tail_at = max(0, size - 22 - 65535)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\5\6")
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\5\6", 0, at)
    if at < 0:
        raise ValueError("no ZIP: it has no end record")
    n, length, start = struct.unpack_from("<HII", tail, at + 10)
    if n == 0xFFFF or 0xFFFFFFFF in (length, start):
        locator = read(tail_at + at - 20, 20)
        if locator[:4] != b"PK\6\7":
            raise ValueError("the ZIP64 locator is missing")
        end = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if end[:4] != b"PK\6\6":
            raise ValueError("the ZIP64 end record is missing")
        n, length, start = struct.unpack_from("<QQQ", end, 32)
    data, out, p = read(start, length), [], 0
    for _ in range(n):
        if data[p : p + 4] != b"PK\1\2":
            raise ValueError("the central directory is broken")
        method, packed, full, n_name, n_extra, n_comment = struct.unpack_from("<10xH8xIIHHH", data, p)
        (header,) = struct.unpack_from("<I", data, p + 42)
        name = data[p + 46 : p + 46 + n_name].decode("utf-8", "replace")
        f = _zip64(data[p + 46 + n_name : p + 46 + n_name + n_extra], {"full": full, "packed": packed, "header": header})
        out.append(Member(name, method, f["packed"], f["header"]))
        p += 46 + n_name + n_extra + n_comment
    return out


def locate(read, size: int, name: str) -> tuple[int, int]:
    """Offset and length of a stored member's bytes."""
    for m in directory(read, size):
        if m.name == name:
            if m.method:
                raise ValueError(f"{name} is compressed")
            local = read(m.header, 30)
            if local[:4] != b"PK\3\4":
                raise ValueError(f"{name} has no local header")
            return m.header + 30 + sum(struct.unpack_from("<HH", local, 26)), m.size
    raise ValueError(f"no member {name}")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """A response record, or a revisit record if refers_to is given, as one gzip member."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        block = http + payload
    else:
        block = http
        lines += [f"WARC-Refers-To: <{_URN}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


class Parsed(NamedTuple):
    page_id: int | None
    kind: str
    payload: bytes
    payload_bytes: int
    digest: str
    refers_to: int | None
    url: str | None


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8").split("\r\n")[1:])}, rest


def _page(urn: str | None) -> int | None:
    digits = (urn or "").strip("<>").removeprefix(_URN)
    return int(digits) if digits else None


def parse(member: bytes) -> Parsed:
    """One record from its gzip member. A response's length and digest are those of the payload that was read."""
    h, rest = _headers(zlib.decompress(member, 31))
    http, payload = _headers(rest[: int(h["content-length"])])
    kind, said = h["warc-type"], h["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and base32_sha1(payload) != said:
        raise ValueError(f"{h['warc-record-id']} has another payload than its digest says")
    size = len(payload) if kind == "response" else int(http["content-length"])
    return Parsed(_page(h["warc-record-id"]), kind, payload, size, said, _page(h.get("warc-refers-to")), h.get("warc-target-uri"))


def write(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes packages of all pages to the shared folder; the manifest (path, n_records, n_bytes), a stored table."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    known = rows.filter(F.col("page_id").isNotNull() & (F.length("payload") >= min_bytes))
    first = known.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    typed = join_small(rows, stored(first, "warc-repeats"), ["digest"]).select(
        "page_id", "url", "payload", F.when((F.col("page_id") != F.col("first")) & (F.length("payload") >= min_bytes), F.col("first")).alias("refers_to")
    )
    root = fresh_dir(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at = open_fs(root)
        out.create_dir(at, recursive=True)
        package: _Package | None = None
        done: list[tuple] = []
        for b in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                package = package or _Package(out, root, at)
                package.add(page_id, record(page_id, url, payload, refers_to))
                if package.offset >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        path, n, size = zip(*done, strict=True) if done else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(path), pa.string()), pa.array(list(n), pa.int64()), pa.array(list(size), pa.int64())], names=["path", "n_records", "n_bytes"])

    return stored(typed.mapInArrow(run, "path string, n_records long, n_bytes long"), "warc-manifest")


class _Package:
    """A ZIP that is being written: records go out at once, their index at the end."""

    def __init__(self, out: fs.FileSystem, root: str, at: str):
        name = f"{uuid.uuid4().hex}.wacz"
        self.path, self.sink = f"{root}/{name}", out.open_output_stream(f"{at}/{name}")
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.offset, self.index = 0, []

    def add(self, page_id: int | None, member: bytes) -> None:
        self.data.write(member)
        self.index.append(f"{'-' if page_id is None else page_id} {json.dumps({'offset': self.offset, 'length': len(member)})}")
        self.offset += len(member)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index) + "\n")
        self.zip.close()
        size = self.sink.tell()
        self.sink.close()
        return self.path, len(self.index), size


def _ranged(path: str):
    """read(offset, n) over a file, and its size."""
    files, at = open_fs(path)
    f = files.open_input_file(at)
    return (lambda offset, n: f.read_at(n, offset)), f.size(), f


def _tasks(packages: DataFrame) -> int:
    """How many tasks read the packages: one for each RANGE_BYTES."""
    n = packages.agg(F.sum("n_bytes") if "n_bytes" in packages.columns else F.count("*") * PACKAGE_BYTES).first()[0] or 0
    return 1 + n // RANGE_BYTES


def ranges(packages: DataFrame, path_col: str = "path") -> DataFrame:
    """(path, offset, length) of every record: bytes of the package, by its directory and index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                read, size, f = _ranged(path)
                with f:
                    start, _ = locate(read, size, DATA)
                    at, n = locate(read, size, INDEX)
                    lines = [json.loads(x.partition(" ")[2]) for x in read(at, n).decode().splitlines()]
                out = [pa.array([path] * len(lines), pa.string()), pa.array([start + x["offset"] for x in lines], pa.int64()), pa.array([x["length"] for x in lines], pa.int64())]
                yield pa.RecordBatch.from_arrays(out, names=["path", "offset", "length"])

    # Rows are small and what they stand for is not, so the number of tasks follows the packages, not the rows' bytes.
    return packages.select(path_col).repartition(_tasks(packages), path_col).mapInArrow(run, "path string, offset long, length long")


def read(packages: DataFrame, path_col: str = "path", payloads: bool = True) -> DataFrame:
    """All records of the packages: page_id, url, record_type, payload_bytes, payload_digest, refers_to and, if wanted, payload (null in revisits)."""
    chunks = ranges(packages, path_col).withColumn("chunk", F.floor(F.col("offset") / RANGE_BYTES))
    chunks = chunks.repartition(_tasks(packages), "path", "chunk").sortWithinPartitions("path", "offset").drop("chunk")
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    fields += [("payload", pa.binary())] if payloads else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, get, f = None, None, None

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [[]] * len(fields)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(cols, fields, strict=True)], schema=pa.schema(fields))

        for b in batches:
            rows, held = [], 0
            for p, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if p != path:
                    if f:
                        f.close()
                    path, (get, _, f) = p, _ranged(p)
                r = parse(get(offset, length))
                rows.append((r.page_id, r.url, r.kind, r.payload_bytes, r.digest, r.refers_to, *([r.payload if r.kind == "response" else None] if payloads else [])))
                held += len(r.payload) if payloads else 0
                if held > _BATCH_BYTES:
                    yield batch(rows)
                    rows, held = [], 0
            yield batch(rows)
        if f:
            f.close()

    ddl = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long" + ", payload binary" * payloads
    return chunks.mapInArrow(run, ddl)
