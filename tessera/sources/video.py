"""Width and height of clips by their headers alone: MP4 and QuickTime boxes; nothing is decoded."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.png import header

_OUTER = {b"moov", b"trak"}


def size_of(data: bytes | None) -> tuple[int, int] | None:
    """The first visible track's sides, or a PNG's; null if they can't be read or one isn't positive."""
    if data is None:
        return None
    if found := header(data):
        return found
    todo = [(0, len(data))]
    while todo:
        at, end = todo.pop(0)
        while at + 8 <= end:
            size, kind = struct.unpack_from(">I4s", data, at)
            body = at + 8
            if size == 1 and at + 16 <= end:
                size, body = struct.unpack_from(">Q", data, at + 8)[0], at + 16
            size = size or end - at
            if size < body - at:
                break
            stop = min(end, at + size)
            if kind in _OUTER:
                todo.append((body, stop))
            elif kind == b"tkhd" and stop - body >= 84:
                place = body + (88 if data[body] == 1 else 76)
                if place + 8 <= stop:
                    width, height = (v >> 16 for v in struct.unpack_from(">II", data, place))
                    if width and height:
                        return width, height
            at += size
    return None


_SIZE = pa.struct([("width", pa.int32()), ("height", pa.int32())])


@F.arrow_udf(T.StructType().add("width", T.IntegerType()).add("height", T.IntegerType()))
def video_size(content: pa.Array) -> pa.Array:
    """Sides of the clips in a column of their bytes, or of their first part if that holds the header."""
    found = [size_of(x.as_py()) for x in content]
    return pa.array([None if s is None else {"width": s[0], "height": s[1]} for s in found], _SIZE)


def with_size(clips: DataFrame, content: Column, least_width: int = 1280, least_height: int = 720) -> DataFrame:
    """clips with width and height, those that can't be read or are too small left out; an error if none is left is the caller's."""
    sized = clips.withColumn("__s", video_size(content))
    out = sized.filter("__s is not null").withColumns({"width": F.col("__s.width"), "height": F.col("__s.height")}).drop("__s")
    return out.filter((F.col("width") >= least_width) & (F.col("height") >= least_height))
