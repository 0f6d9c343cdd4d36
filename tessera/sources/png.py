"""PNG files by zlib and numpy: 8-bit grey, RGB and RGBA, not interlaced."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def header(data: bytes) -> tuple[int, int] | None:
    """Width and height by the header alone; null if it is no PNG or a side isn't positive."""
    if data[:8] != _SIGNATURE or len(data) < 24:
        return None
    width, height = struct.unpack_from(">II", data, 16)
    return (width, height) if width and height else None


def encode(pixels: np.ndarray, level: int = 3) -> bytes:
    """A PNG of grey or BGR pixels (uint8)."""
    if pixels.ndim == 3:
        pixels, kind = pixels[:, :, ::-1], 2
    else:
        pixels, kind = pixels[:, :, None], 0
    height, width, n = pixels.shape
    rows = np.zeros((height, width * n + 1), np.uint8)
    rows[:, 1:] = pixels.reshape(height, -1)

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    return _SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + chunk(b"IEND", b"")


def decode(data: bytes | None) -> np.ndarray | None:
    """Grey (height x width) or BGR pixels; null if the data can't be read."""
    try:
        if data is None or data[:8] != _SIGNATURE:
            return None
        at, body, head = 8, [], None
        while at + 8 <= len(data):
            n, name = struct.unpack_from(">I4s", data, at)
            if name == b"IHDR":
                head = struct.unpack_from(">IIBBBBB", data, at + 8)
            elif name == b"IDAT":
                body.append(data[at + 8 : at + 8 + n])
            at += n + 12
        width, height, depth, kind, _, _, interlaced = head
        if depth != 8 or interlaced or kind not in _CHANNELS:
            return None
        n = _CHANNELS[kind]
        rows = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width * n + 1)
        pixels = _unfiltered(rows, n).reshape(height, width, n)
    except (ValueError, TypeError, struct.error, zlib.error):
        return None
    return pixels[:, :, 0].copy() if n <= 2 else np.ascontiguousarray(pixels[:, :, 2::-1])


def _unfiltered(rows: np.ndarray, n: int) -> np.ndarray:
    """Pixels from filtered rows: none, left, up, mean and Paeth."""
    kinds, out = rows[:, 0], rows[:, 1:].astype(np.int32)
    before = np.zeros(out.shape[1], np.int32)
    for y, kind in enumerate(kinds):
        line = out[y]
        if kind == 1:
            line[:] = np.cumsum(line.reshape(-1, n), axis=0).ravel() & 255
        elif kind == 2:
            line[:] = (line + before) & 255
        elif kind in (3, 4):
            for x in range(len(line)):
                a = int(line[x - n]) if x >= n else 0
                b, c = int(before[x]), int(before[x - n]) if x >= n else 0
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    p = a + b - c
                    guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                line[x] = (line[x] + guess) & 255
        elif kind:
            raise ValueError("unknown filter")
        before = line
    return out.astype(np.uint8)
