"""Recordings: SQLite files and bags of messages, as Python data sources, and the images in their messages.

The files are opened by path in the workers, so they must lie in a file system that all of them mount.
"""

from __future__ import annotations

import bz2
import io
import sqlite3
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition
from tessera.sources.files import recording_format

MESSAGES = "topic_id int, topic string, type string, timestamp_ns bigint, data binary"
ENCODINGS = {"rgb8": (3, "rgb"), "bgr8": (3, "bgr"), "rgba8": (4, "rgb"), "bgra8": (4, "bgr"), "mono8": (1, "mono")}
#: Alignment of numbers, and closing bytes of a text, in the messages of a format.
LAYOUTS = {"rosbag2": (4, 1), "rosbag1": (1, 0)}


class Range(InputPartition):
    """A topic's messages between two times, the end left out."""

    def __init__(self, path: str, topic: int, start: int, end: int):
        super().__init__((path, topic, start, end))
        self.path, self.topic, self.start, self.end = path, topic, start, end


class SqliteReader(DataSourceReader):
    """Reads by topic and range of time; a filter on topic_id reaches the file."""

    def __init__(self, options: dict):
        self.path = options.get("path", "").removeprefix("file://")
        self.ranges = max(1, int(options.get("ranges", 8)))
        self.topic: int | None = None

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("topic_id",):
                self.topic = f.value
            else:
                yield f

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self):
        out = []
        db = self._open()
        try:
            for topic, low, high in db.execute("SELECT topic_id, min(timestamp), max(timestamp) FROM messages GROUP BY topic_id"):
                if self.topic is None or topic == self.topic:
                    step = (high - low) // self.ranges + 1
                    out += [Range(self.path, topic, t, t + step) for t in range(low, high + 1, step)]
        finally:
            db.close()
        return out or [Range(self.path, -1, 0, 0)]

    def read(self, part: Range) -> Iterator[tuple]:
        db = self._open()
        try:
            rows = db.execute(
                "SELECT t.id, t.name, t.type, m.timestamp, m.data FROM messages m JOIN topics t ON t.id = m.topic_id WHERE m.topic_id = ? AND m.timestamp >= ? AND m.timestamp < ? ORDER BY m.timestamp",
                (part.topic, part.start, part.end),
            )
            yield from rows
        finally:
            db.close()


class SqliteRecording(DataSource):
    """format("rosbag2"): the messages of a .db3 file; option ranges: parts of each topic."""

    @classmethod
    def name(cls) -> str:
        return "rosbag2"

    def schema(self) -> str:
        return MESSAGES

    def reader(self, schema) -> SqliteReader:
        return SqliteReader(self.options)


def _fields(header: bytes) -> dict[str, bytes]:
    out, at = {}, 0
    while at < len(header):
        (n,) = struct.unpack_from("<I", header, at)
        key, _, value = header[at + 4 : at + 4 + n].partition(b"=")
        out[key.decode()] = value
        at += 4 + n
    return out


def bag_records(f) -> Iterator[tuple[dict[str, bytes], bytes]]:
    """Header and data of each record of a version 2.0 bag, those in chunks included."""
    _start(f)
    yield from _records(f)


def _start(f) -> None:
    if not f.readline().startswith(b"#ROSBAG V2.0"):
        raise ValueError("no bag of version 2.0")


def _record(f) -> tuple[dict[str, bytes], bytes] | None:
    size = f.read(4)
    if len(size) < 4:
        return None
    header = _fields(f.read(struct.unpack("<I", size)[0]))
    return header, f.read(struct.unpack("<I", f.read(4))[0])


def _records(f) -> Iterator[tuple[dict[str, bytes], bytes]]:
    while record := _record(f):
        if record[0].get("op") == b"\5":
            yield from _records(io.BytesIO(_chunk(*record)))
        else:
            yield record


def _chunk(header: dict[str, bytes], data: bytes) -> bytes:
    """What a chunk holds: stored, bz2, or an lz4 frame."""
    kind = header.get("compression", b"none")
    if kind == b"none":
        return data
    if kind == b"bz2":
        return bz2.decompress(data)
    if kind == b"lz4":
        return pa.decompress(data, struct.unpack("<I", header["size"])[0], codec="lz4", asbytes=True)
    raise ValueError(f"chunks compressed by {kind.decode()} can't be read")


class Chunks(InputPartition):
    """Chunks of a bag, by their places in the file; none: the whole file, from the front."""

    def __init__(self, path: str, places: tuple[int, ...] | None):
        super().__init__((path, places))
        self.path, self.places = path, places


class BagReader(DataSourceReader):
    """Reads runs of chunks by the index at the bag's end, or a bag without an index from the front, in one task."""

    def __init__(self, options: dict):
        self.path = options.get("path", "").removeprefix("file://")
        self.ranges = max(1, int(options.get("ranges", 8)))

    def _index(self, f) -> tuple[list[int], dict[bytes, tuple[int, str, str]]]:
        """Places of the chunks and the connections, by the index; nothing if there is none."""
        _start(f)
        first = _record(f)
        at = struct.unpack("<Q", first[0]["index_pos"])[0] if first and first[0].get("op") == b"\3" else 0
        if not at:
            return [], {}
        f.seek(at)
        places, topics = [], {}
        while record := _record(f):
            header, data = record
            if header.get("op") == b"\6":
                places.append(struct.unpack("<Q", header["chunk_pos"])[0])
            elif header.get("op") == b"\7":
                topics[header["conn"]] = self._topic(header, data)
        return places, topics

    @staticmethod
    def _topic(header: dict[str, bytes], data: bytes) -> tuple[int, str, str]:
        return struct.unpack("<I", header["conn"])[0], header["topic"].decode(), _fields(data).get("type", b"").decode()

    def partitions(self):
        with open(self.path, "rb") as f:
            places = sorted(self._index(f)[0])
        if not places:
            return [Chunks(self.path, None)]
        step = -(-len(places) // self.ranges)
        return [Chunks(self.path, tuple(places[i : i + step])) for i in range(0, len(places), step)]

    def read(self, part: Chunks) -> Iterator[tuple]:
        with open(part.path, "rb") as f:
            topics: dict[bytes, tuple[int, str, str]] = {}
            if part.places is not None:
                topics = self._index(f)[1]

            def records() -> Iterator[tuple[dict[str, bytes], bytes]]:
                if part.places is None:
                    f.seek(0)
                    yield from bag_records(f)
                for place in part.places or ():
                    f.seek(place)
                    yield from _records(io.BytesIO(_chunk(*_record(f))))

            for header, data in records():
                if header.get("op") == b"\7":
                    topics[header["conn"]] = self._topic(header, data)
                elif header.get("op") == b"\2" and header["conn"] in topics:
                    s, ns = struct.unpack("<II", header["time"])
                    yield *topics[header["conn"]], s * 1_000_000_000 + ns, data


class BagRecording(DataSource):
    """format("rosbag1"): the messages of a .bag file, in its order within a chunk; option ranges: parts of its chunks."""

    @classmethod
    def name(cls) -> str:
        return "rosbag1"

    def schema(self) -> str:
        return MESSAGES

    def reader(self, schema) -> BagReader:
        return BagReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes both formats known; filters are pushed into Python sources from now on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteRecording)
    spark.dataSource.register(BagRecording)


def read_recording(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format(recording_format(path)).load(path)


def decode_image(data: bytes | None, recording: str = "rosbag2") -> dict | None:
    """Height, width and BGR bytes of a serialised image message, laid out as its recording's format says; null if it can't be decoded.

    rosbag2 has little-endian CDR: an encapsulation, fields aligned to four bytes, texts with a closing NUL. rosbag1 has a
    sequence number in place of the encapsulation, no padding and no NUL.
    """
    align, nul = LAYOUTS[recording]
    try:
        at = 4 + 8  # encapsulation or sequence number, time stamp

        def number(at: int) -> tuple[int, int]:
            at += -(at - 4) % align
            return struct.unpack_from("<I", data, at)[0], at + 4

        n, at = number(at)
        at += n
        height, at = number(at)
        width, at = number(at)
        n, at = number(at)
        encoding, at = data[at : at + n - nul].decode(), at + n
        at += 1  # byte order of wider samples
        step, at = number(at)
        n, at = number(at)
        channels, order = ENCODINGS[encoding]
        raw = np.frombuffer(data, np.uint8, n, at).reshape(height, step)[:, : width * channels].reshape(height, width, channels)
    except (KeyError, ValueError, struct.error, TypeError, UnicodeDecodeError):
        return None
    pixels = np.repeat(raw, 3, axis=2) if order == "mono" else raw[:, :, 2::-1] if order == "rgb" else raw[:, :, :3]
    return {"height": height, "width": width, "data": np.ascontiguousarray(pixels).tobytes()}


_IMAGE = pa.struct([("height", pa.int32()), ("width", pa.int32()), ("data", pa.binary())])


def with_images(messages: DataFrame, data: str = "data", name: str = "image", recording: str = "rosbag2") -> DataFrame:
    """messages whose image can be decoded, with it; do this before sampling, as others don't take a slot.

    recording is the format that the messages come from, as recording_format(path) gives it.
    """
    if recording not in LAYOUTS:
        raise ValueError(f"no format of recordings: {recording}")

    @F.arrow_udf("height int, width int, data binary")
    def decoded(column: pa.Array) -> pa.Array:
        return pa.array([decode_image(x.as_py(), recording) for x in column], _IMAGE)

    return messages.withColumn(name, decoded(data)).filter(F.col(name).isNotNull())
