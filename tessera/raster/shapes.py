"""Polygons and masks: fills, contours, run lengths."""

from __future__ import annotations

import numpy as np


def _outline(mask: np.ndarray, poly: np.ndarray) -> None:
    """Sets the pixels on a polygon's edges."""
    for (x0, y0), (x1, y1) in zip(poly, np.roll(poly, -1, axis=0), strict=True):
        n = int(max(abs(x1 - x0), abs(y1 - y0))) + 1
        x = np.rint(np.linspace(x0, x1, n)).astype(int)
        y = np.rint(np.linspace(y0, y1, n)).astype(int)
        inside = (x >= 0) & (x < mask.shape[1]) & (y >= 0) & (y < mask.shape[0])
        mask[y[inside], x[inside]] = 1


def fill_parity(polygons: list, width: int, height: int) -> np.ndarray:
    """Pixels inside an odd number of the polygons, and those on their edges, as 0 and 1; vertices are cut to whole pixels."""
    polys = [np.trunc(np.asarray(p, float).reshape(-1, 2)).astype(int) for p in polygons]
    mask = np.zeros((height, width), np.uint8)
    edges = [np.concatenate([p, np.roll(p, -1, axis=0)], axis=1) for p in polys if len(p)]
    if not edges:
        return mask
    e = np.concatenate(edges)
    for y in range(max(0, int(e[:, 1].min())), min(height - 1, int(e[:, 1].max())) + 1):
        cut = ((e[:, 1] <= y) & (e[:, 3] > y)) | ((e[:, 3] <= y) & (e[:, 1] > y))
        c = e[cut]
        xs = np.sort(c[:, 0] + (y - c[:, 1]) * (c[:, 2] - c[:, 0]) / (c[:, 3] - c[:, 1]))
        for a, b in zip(xs[0::2], xs[1::2], strict=False):
            mask[y, max(0, int(np.ceil(a))) : max(0, int(np.floor(b)) + 1)] = 1
    for p in polys:
        if len(p):
            _outline(mask, p)
    return mask


def fill_union(polygons: list, width: int, height: int) -> np.ndarray:
    """Pixels inside or on the edge of any of the polygons, as 0 and 1."""
    mask = np.zeros((height, width), np.uint8)
    for p in polygons:
        mask |= fill_parity([p], width, height)
    return mask


def shoelace(points: np.ndarray) -> float:
    """The enclosed area, without sign."""
    x, y = points[:, 0].astype(float), points[:, 1].astype(float)
    return abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))) / 2


def components(mask: np.ndarray) -> np.ndarray:
    """Numbers from 1 of the 8-connected regions, 0 elsewhere: runs of rows joined by union and find."""
    out = np.zeros(mask.shape, np.int32)
    parent = [0]

    def find(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    above: list[tuple[int, int, int]] = []
    for y, row in enumerate(mask > 0):
        steps = np.flatnonzero(np.diff(np.concatenate([[0], row.view(np.int8), [0]])))
        runs, k = [], 0
        for a, b in zip(steps[0::2].tolist(), steps[1::2].tolist(), strict=True):
            while k < len(above) and above[k][1] < a:
                k += 1
            label, j = 0, k
            while j < len(above) and above[j][0] <= b:
                other = find(above[j][2])
                if label and other != label:
                    parent[max(label, other)] = min(label, other)
                    label = min(label, other)
                label = label or other
                j += 1
            if not label:
                label = len(parent)
                parent.append(label)
            out[y, a:b] = label
            runs.append((a, b, label))
        above = runs
    roots = np.array([find(i) for i in range(len(parent))])
    _, dense = np.unique(roots, return_inverse=True)
    return dense[out].astype(np.int32)


#: The eight neighbours, clockwise from the east, y downwards.
_AROUND = [(1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1)]


def outer_border(region: np.ndarray) -> np.ndarray:
    """The outer border of one 8-connected region, clockwise from its first pixel, corners only."""
    ys, xs = np.nonzero(region)
    start = (int(xs[0]), int(ys[0]))
    height, width = region.shape
    on = lambda x, y: 0 <= x < width and 0 <= y < height and region[y, x]
    path, at, came = [start], start, 4  # the pixel west of the first one is outside
    first_step = None
    while True:
        for k in range(1, 9):
            d = (came + k) % 8
            x, y = at[0] + _AROUND[d][0], at[1] + _AROUND[d][1]
            if on(x, y):
                break
        else:
            return np.array(path)
        if at == start and first_step is None:
            first_step = d
        elif at == start and d == first_step:
            break
        at, came = (x, y), (d + 4) % 8
        path.append(at)
    points = np.array(path[:-1] if len(path) > 1 and path[-1] == start else path)
    if len(points) < 3:
        return points
    before, after = points - np.roll(points, 1, axis=0), np.roll(points, -1, axis=0) - points
    return points[(before != after).any(axis=1)]


def largest_contour(mask: np.ndarray, least: float = 6.0) -> np.ndarray | None:
    """The outer border of the region whose border encloses most; null if that is under `least` or it has under 3 points."""
    best, size = None, -1.0
    regions = components(mask)
    for k in range(1, int(regions.max()) + 1):
        ys, xs = np.nonzero(regions == k)
        y0, x0 = ys.min(), xs.min()
        border = outer_border((regions[y0 : ys.max() + 1, x0 : xs.max() + 1] == k).astype(np.uint8)) + [x0, y0]
        if len(border) >= 3 and (a := shoelace(border)) > size:
            best, size = border, a
    return best if best is not None and size >= least else None


def tight_box(mask: np.ndarray) -> tuple[int, int, int, int] | None:
    """x0, y0, x1, y1 of the set pixels, ends left out; null if there are none."""
    ys, xs = np.nonzero(mask)
    return (int(xs.min()), int(ys.min()), int(xs.max()) + 1, int(ys.max()) + 1) if len(xs) else None


def counts_of(text: str) -> list[int]:
    """Run lengths of a compressed string: base 32 digits from character 48, low first, the sign in the last one, differences to the count two before."""
    out: list[int] = []
    at = 0
    while at < len(text):
        value, shift, more = 0, 0, True
        while more:
            digit = ord(text[at]) - 48
            value |= (digit & 31) << shift
            more, shift, at = bool(digit & 32), shift + 5, at + 1
            if not more and digit & 16:
                value -= 1 << shift
        out.append(value + (out[-2] if len(out) > 2 else 0))
    return out


def decode_rle(size: list[int], counts: list[int] | str) -> np.ndarray:
    """A mask (0 and 1) from run lengths down its columns, zeros first."""
    runs = counts_of(counts) if isinstance(counts, str) else counts
    flat = np.repeat(np.arange(len(runs)) % 2, runs).astype(np.uint8)
    height, width = size
    if len(flat) != height * width:
        raise ValueError("run lengths don't fill the mask")
    return flat.reshape(width, height).T.copy()
