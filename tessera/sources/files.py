"""Paths and listings."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.strings import VIDEO_SUFFIXES, has_suffix


def resolved(path: str, root: str) -> str:
    """A path with ~ expanded; relative ones lie under root; URIs stay."""
    if "://" in path:
        return path
    path = os.path.expanduser(path)
    return path if os.path.isabs(path) else os.path.join(root, path)


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length, modified) of the files below a path; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def videos(files: DataFrame, path: str = "path") -> DataFrame:
    """The recordings and clips of a listing, in the order of their paths."""
    return files.filter(has_suffix(F.col(path), VIDEO_SUFFIXES)).orderBy(path)


def recording_format(path: str) -> str:
    """The source that reads a recording."""
    end = os.path.splitext(path)[1].lower()
    formats = {".bag": "rosbag1", ".db3": "rosbag2"}
    if end not in formats:
        raise ValueError(f"{path} is no recording: one of {', '.join(formats)} is needed")
    return formats[end]
