"""Media columns: ISO base media containers read by their boxes, payloads left undecoded.

`walk` yields the nested boxes of a container, `probe_tracks` decodes each track's own sample tables: codec,
duration, and the byte ranges of samples and keyframes; `probe` gives the first track. All read through a function of offset and length, so only
the boxes' headers and tables are touched. `pack` writes a container around raw 8-bit samples.

Edge cases. Null text counts as empty. A payload is never empty: it is padded with blanks to a positive multiple
of BLOCK. Bytes that aren't a readable container give nulls and an `error`, and so do fragmented files (moof), whose
samples lie outside the tables; a null container gives nulls. A track that can't be read has its own error in `tracks`.
Repeated rows and null ids stay. An empty table gives no rows. Other columns are ignored by digests() and
kept by probe_columns().
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from hashlib import sha256
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import unused

BLOCK = 192
TIMESCALE = 8000
#: Samples in a chunk, and between keyframes.
CHUNK, KEY_EVERY = 1024, 64
#: Boxes that hold boxes, with the bytes before the first of them.
CONTAINERS = {b"moov": 0, b"trak": 0, b"mdia": 0, b"minf": 0, b"stbl": 0, b"dinf": 0, b"edts": 0, b"udta": 0, b"moof": 0, b"traf": 0, b"mvex": 0}
MAX_DEPTH = 16

Read = Callable[[int, int], bytes]


class Box(NamedTuple):
    path: str
    start: int
    body: int
    end: int


class Track(NamedTuple):
    codec: str
    timescale: int
    duration: int
    sizes: np.ndarray
    offsets: np.ndarray
    keyframes: np.ndarray


def walk(read: Read, start: int, end: int, path: str = "", depth: int = 0) -> Iterator[Box]:
    """All boxes between two offsets, outer ones first; 64-bit sizes and boxes that reach to the end included."""
    if depth > MAX_DEPTH:
        raise ValueError("boxes are nested too deep")
    while start < end:
        head = read(start, min(16, end - start))
        if len(head) < 8:
            raise ValueError(f"a box at {start} is cut off")
        size, kind = struct.unpack_from(">I4s", head)
        body = start + 8
        if size == 1:
            if len(head) < 16:
                raise ValueError(f"a box at {start} is cut off")
            size, body = struct.unpack_from(">Q", head, 8)[0], start + 16
        elif size == 0:
            size = end - start
        if size < body - start or start + size > end:
            raise ValueError(f"a box at {start} has a wrong size")
        name = f"{path}/{kind.decode('latin-1')}"
        yield Box(name, start, body, start + size)
        if kind in CONTAINERS:
            yield from walk(read, body + CONTAINERS[kind], start + size, name, depth + 1)
        start += size


def _table(read: Read, box: Box, head: str, row: str) -> tuple[tuple, np.ndarray]:
    """The fields after a full box's version and flags, and its rows, whose number is the last field."""
    skip = struct.calcsize(head)
    fields = struct.unpack(head, read(box.body, skip))
    n, dtype = fields[-1], np.dtype(row)
    if box.body + skip + n * dtype.itemsize > box.end:
        raise ValueError(f"{box.path} is cut off")
    return fields, np.frombuffer(read(box.body + skip, n * dtype.itemsize), dtype)


def probe(read: Read, size: int) -> Track:
    """The first track of a container of so many bytes."""
    return _first(probe_tracks(read, size))


def _first(tracks: list[Track | str]) -> Track:
    if isinstance(tracks[0], str):
        raise ValueError(tracks[0])
    return tracks[0]


def probe_tracks(read: Read, size: int) -> list[Track | str]:
    """Every track of a container of so many bytes, by its own sample tables alone, or why it can't be read."""
    traks: list[dict[str, Box]] = []
    for box in walk(read, 0, size):
        if box.path == "/moof":
            raise ValueError("fragmented containers can't be read")
        if box.path == "/moov/trak":
            traks.append({})
        elif box.path.startswith("/moov/trak/"):
            traks[-1].setdefault(box.path.rsplit("/", 1)[1], box)
    if not traks:
        raise ValueError("no trak box")
    out: list[Track | str] = []
    for boxes in traks:
        try:
            out.append(_track(read, size, boxes))
        except (ValueError, struct.error) as e:
            out.append(str(e) or "unreadable")
    return out


def _track(read: Read, size: int, boxes: dict[str, Box]) -> Track:
    for need in ("mdhd", "stsd", "stts", "stsc", "stsz"):
        if need not in boxes:
            raise ValueError(f"no {need} box")
    m = boxes["mdhd"]
    wide = read(m.body, 1) == b"\x01"
    timescale, duration = struct.unpack(">IQ" if wide else ">II", read(m.body + (20 if wide else 12), 12 if wide else 8))
    codec = read(boxes["stsd"].body + 12, 4).decode("latin-1")
    z = boxes["stsz"]
    _, each, n = struct.unpack(">III", read(z.body, 12))
    sizes = np.full(n, each, np.int64) if each else np.frombuffer(read(z.body + 12, 4 * n), ">u4").astype(np.int64)
    if "co64" in boxes:
        _, chunks = _table(read, boxes["co64"], ">II", ">u8")
    elif "stco" in boxes:
        _, chunks = _table(read, boxes["stco"], ">II", ">u4")
    else:
        raise ValueError("no stco or co64 box")
    _, runs = _table(read, boxes["stsc"], ">II", ">u4,>u4,>u4")
    offsets = sample_offsets(sizes, chunks.astype(np.int64), runs["f0"].astype(np.int64), runs["f1"].astype(np.int64))
    _, times = _table(read, boxes["stts"], ">II", ">u4,>u4")
    if len(sizes) and int(times["f0"].astype(np.int64).sum()) != len(sizes):
        raise ValueError("the tables differ in their number of samples")
    if len(sizes) and int((offsets + sizes).max()) > size:
        raise ValueError("samples lie beyond the end")
    keys = np.arange(n) if "stss" not in boxes else _table(read, boxes["stss"], ">II", ">u4")[1].astype(np.int64) - 1
    if len(keys) and not 0 <= keys.min() <= keys.max() < n:
        raise ValueError("a keyframe is no sample")
    return Track(codec, timescale, duration, sizes, offsets, keys)


def sample_offsets(sizes: np.ndarray, chunks: np.ndarray, first: np.ndarray, per_chunk: np.ndarray) -> np.ndarray:
    """Where each sample begins, by chunk offsets and runs of chunks with equal numbers of samples."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    if not len(first) or first[0] != 1:
        raise ValueError("chunks without a run")
    counts = np.repeat(per_chunk, np.diff(np.append(first, len(chunks) + 1)))
    if int(counts.sum()) != len(sizes):
        raise ValueError("the tables differ in their number of samples")
    before = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    start = np.concatenate([[0], np.cumsum(counts)[:-1]])
    full = counts > 0
    return np.repeat(chunks[full] - before[start[full]], counts[full]) + before


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 >= 1 << 32:
        return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body
    return struct.pack(">I4s", len(body) + 8, kind) + body


def pack(payload: bytes, block: int = BLOCK, timescale: int = TIMESCALE) -> bytes:
    """A container with the payload as one track of unsigned 8-bit mono samples (codec `raw `), block bytes a sample."""
    n, rest = divmod(len(payload), block)
    if rest or not n:
        raise ValueError(f"the payload must be a positive multiple of {block} bytes")
    full, duration, matrix = b"\0\0\0\0", n * block, struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    wide = duration >= 1 << 32
    clock = struct.pack(">QQIQ", 0, 0, timescale, duration) if wide else struct.pack(">IIII", 0, 0, timescale, duration)
    version = b"\1\0\0\0" if wide else full
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2mp41")
    entry = _box(b"raw ", bytes(6), struct.pack(">H8xHHHHI", 1, 1, 8, 0, 0, timescale << 16))
    chunks = -(-n // CHUNK)
    runs = [(1, min(n, CHUNK), 1)] + ([(chunks, n % CHUNK, 1)] if n > CHUNK and n % CHUNK else [])
    keys = np.arange(1, n + 1, KEY_EVERY)
    track_clock = struct.pack(">QQIIQ", 0, 0, 1, 0, duration) if wide else struct.pack(">IIIII", 0, 0, 1, 0, duration)

    def moov(at: int) -> bytes:
        offsets = at + np.arange(chunks, dtype=np.uint64) * np.uint64(CHUNK * block)
        big = len(payload) >= 1 << 31
        stbl = _box(
            b"stbl",
            _box(b"stsd", full, struct.pack(">I", 1), entry),
            _box(b"stts", full, struct.pack(">III", 1, n, block)),
            _box(b"stsc", full, struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            _box(b"stsz", full, struct.pack(">II", block, n)),
            _box(b"stss", full, struct.pack(">I", len(keys)), keys.astype(">u4").tobytes()),
            _box(b"co64" if big else b"stco", full, struct.pack(">I", chunks), offsets.astype(">u8" if big else ">u4").tobytes()),
        )
        minf = _box(b"minf", _box(b"smhd", full, bytes(4)), _box(b"dinf", _box(b"dref", full, struct.pack(">I", 1), _box(b"url ", b"\0\0\0\1"))), stbl)
        mdia = _box(b"mdia", _box(b"mdhd", version, clock, struct.pack(">HH", 0x55C4, 0)), _box(b"hdlr", full, bytes(4), b"soun", bytes(12), b"samples\0"), minf)
        tkhd = _box(b"tkhd", version[:1] + b"\0\0\7", track_clock, bytes(8), struct.pack(">HHHH", 0, 0, 0x100, 0), matrix, bytes(8))
        mvhd = _box(b"mvhd", version, clock, struct.pack(">IH10x", 0x10000, 0x100), matrix, bytes(24), struct.pack(">I", 2))
        return _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))

    head = 16 if len(payload) + 8 >= 1 << 32 else 8
    return ftyp + moov(len(ftyp) + len(moov(0)) + head) + _box(b"mdat", payload)


def reader(data: bytes) -> Read:
    return lambda offset, n: data[offset : offset + n]


def payload_of(read: Read, track: Track) -> bytes:
    """All samples of a track in order; neighbours are read at once."""
    if not len(track.sizes):
        return b""
    gap = np.flatnonzero(track.offsets[1:] != track.offsets[:-1] + track.sizes[:-1]) + 1
    first, last = np.concatenate([[0], gap]), np.concatenate([gap, [len(track.sizes)]]) - 1
    return b"".join(read(int(track.offsets[a]), int(track.offsets[b] + track.sizes[b] - track.offsets[a])) for a, b in zip(first, last, strict=True))


def feature(track: Track) -> str:
    """Codec, duration and keyframes as one line: their number, the first and last byte range, and a digest of all."""
    ranges = np.stack([track.offsets[track.keyframes], track.sizes[track.keyframes]], axis=1).astype(">i8")
    ends = [f"{o}+{s}" for o, s in (ranges[[0, -1]].tolist() if len(ranges) else [])]
    return f"codec={track.codec.strip()};duration={track.duration}/{track.timescale};samples={len(track.sizes)};keyframes={len(ranges)}:{','.join(ends)};ranges={sha256(ranges.tobytes()).hexdigest()[:16]}"


def padded(text: bytes, block: int = BLOCK) -> bytes:
    """The text with blanks up to the next positive multiple of block."""
    return text + b" " * (-len(text) % block if text else block)


_TRACK = T.StructType(
    [
        T.StructField("codec", T.StringType()),
        T.StructField("duration_s", T.DoubleType()),
        T.StructField("n_samples", T.LongType()),
        T.StructField("keyframes", T.ArrayType(T.StructType([T.StructField("offset", T.LongType()), T.StructField("size", T.LongType())]))),
        T.StructField("error", T.StringType()),
    ]
)
_PROBED = T.StructType([*_TRACK, T.StructField("tracks", T.ArrayType(_TRACK))])
_TRACK_ARROW = [pa.string(), pa.float64(), pa.int64(), pa.list_(pa.struct([("offset", pa.int64()), ("size", pa.int64())])), pa.string()]
_PROBED_ARROW = [*_TRACK_ARROW, pa.list_(pa.struct([(f.name, t) for f, t in zip(_TRACK, _TRACK_ARROW, strict=True)]))]


def probe_columns(media: DataFrame, media_col: str = "media") -> DataFrame:
    """media with codec, duration_s, n_samples, keyframes (byte ranges) and error of its containers' first tracks, and `tracks`, which has these of every track."""
    names = unused(media, *(f.name for f in _PROBED))
    schema = T.StructType([*media.schema.fields, *(T.StructField(n, f.dataType) for n, f in zip(names, _PROBED, strict=True))])
    at = media.columns.index(media_col)
    fields = _TRACK.fieldNames()

    def entry(t: Track | str) -> tuple:
        if isinstance(t, str):
            return None, None, None, None, t
        ranges = [{"offset": int(t.offsets[k]), "size": int(t.sizes[k])} for k in t.keyframes]
        return t.codec, t.duration / t.timescale if t.timescale else None, len(t.sizes), ranges, None

    def one(data: bytes | None) -> tuple:
        if data is None:
            return (None,) * 6
        try:
            entries = [entry(t) for t in probe_tracks(reader(data), len(data))]
        except (ValueError, struct.error) as e:
            return None, None, None, None, str(e) or "unreadable", None
        return *entries[0], [dict(zip(fields, x, strict=True)) for x in entries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = list(zip(*(one(x.as_py()) for x in b.column(at)), strict=True)) or [[]] * len(names)
            out = [pa.array(list(v), t) for v, t in zip(got, _PROBED_ARROW, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, *out], schema=pa.schema([*b.schema, *(pa.field(n, a.type) for n, a in zip(names, out, strict=True))]))

    return media.mapInArrow(run, schema)


def pack_texts(docs: DataFrame, text_col: str = "text", media_col: str = "media") -> DataFrame:
    """docs with a container of each whole text, padded, in a further column."""
    (name,) = unused(docs, media_col)
    rows = docs.withColumn(name, F.col(text_col).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            media = pa.array([pack(padded(x.as_py() or b"")) for x in b.column(b.num_columns - 1)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], media], schema=pa.schema([*list(b.schema)[:-1], pa.field(name, media.type)]))

    return rows.mapInArrow(run, rows.schema)


_DIGESTS = ("n_bytes long", "payload_bytes long", "payload_sha256 string", "tail_crc32 long", "media_bytes long", "media_sha256 string", "feature string")


def digest(text: bytes) -> tuple:
    """What digests() returns for one text: packed, probed and read back from the container's bytes."""
    media = pack(padded(text))
    read = reader(media)
    track = probe(read, len(media))
    payload = payload_of(read, track)
    return len(text), len(payload), sha256(payload).hexdigest(), crc32(payload[-16:]), len(media), sha256(media).hexdigest(), feature(track)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id with sizes, digests and features of its text's container; containers needn't leave the worker."""
    rows = docs.select(id_col, F.col(text_col).cast("binary").alias("__text"))
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = list(zip(*(digest(x.as_py() or b"") for x in b.column(1)), strict=True)) or [[]] * len(types)
            out = [pa.array(list(v), t) for v, t in zip(got, types, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *out], schema=pa.schema([b.schema.field(0), *(pa.field(n.split()[0], t) for n, t in zip(_DIGESTS, types, strict=True))]))

    more = T.StructType.fromDDL(", ".join(_DIGESTS))
    return rows.mapInArrow(run, T.StructType([rows.schema.fields[0], *more.fields]))
