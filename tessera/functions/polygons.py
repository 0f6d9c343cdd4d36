"""Polygons as flat arrays [x0, y0, x1, y1, ...], as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def n_points(flat: Column) -> Column:
    return F.floor(F.size(flat) / 2).cast("int")


def _checked(flat: Column) -> Column:
    return F.when(F.pmod(F.size(flat), F.lit(2)) == 1, F.raise_error(F.lit("a polygon has an odd number of coordinates")).cast("array<double>")).otherwise(flat)


def points(flat: Column) -> Column:
    """The points as structs of x and y; an odd number of coordinates is an error."""
    flat = _checked(flat)
    at = F.filter(F.transform(flat, lambda v, i: F.struct(v.cast("double").alias("x"), F.get(flat, i + 1).cast("double").alias("y"), i.alias("i"))), lambda p: F.pmod(p["i"], F.lit(2)) == 0)
    return F.transform(at, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))


def normalized(flat: Column, width: Column, height: Column, clip: bool = False) -> Column:
    """Coordinates over the image's sides, in single precision and within 0 and 1 if clipped."""

    def one(v: Column, i: Column) -> Column:
        side = F.when(F.pmod(i, F.lit(2)) == 0, width).otherwise(height)
        if not clip:
            return v.cast("double") / side
        return F.greatest(F.lit(0.0).cast("float"), F.least(F.lit(1.0).cast("float"), (v.cast("float") / side.cast("float")).cast("float")))

    return F.transform(flat, one)


def to_pixels(flat: Column, width: Column, height: Column) -> Column:
    """Normalised coordinates as whole pixels, cut towards zero."""
    return F.transform(flat, lambda v, i: (v * F.when(F.pmod(i, F.lit(2)) == 0, width).otherwise(height)).cast("int"))


def _axis(flat: Column, odd: int) -> Column:
    return F.filter(flat, lambda v, i: F.pmod(i, F.lit(2)) == odd)


def bounds(flat: Column) -> Column:
    """Smallest and largest x and y."""
    x, y = _axis(flat, 0), _axis(flat, 1)
    return F.struct(F.array_min(x).alias("x0"), F.array_min(y).alias("y0"), F.array_max(x).alias("x1"), F.array_max(y).alias("y1"))


def pixel_rect(flat: Column) -> Column:
    """The rectangle of whole pixels that holds a polygon of whole pixels; sides count both ends."""
    b = bounds(flat)
    return F.struct(b["x0"].alias("x"), b["y0"].alias("y"), (b["x1"] - b["x0"] + 1).alias("w"), (b["y1"] - b["y0"] + 1).alias("h"))


def area(flat: Column) -> Column:
    """The enclosed area by the shoelace formula, without sign."""
    n = F.size(flat)
    at = lambda i: F.get(flat, F.pmod(i, n).cast("int")).cast("double")
    cross = F.transform(flat, lambda v, i: F.when(F.pmod(i, F.lit(2)) == 0, at(i) * at(i + 3) - at(i + 2) * at(i + 1)).otherwise(F.lit(0.0)))
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda a, x: a + x)) / 2


def first_polygon(polygons: Column) -> Column:
    """The first of several polygons; null where there is none or it is empty."""
    first = F.get(polygons, 0)
    return F.when(F.size(first) > 0, first)


def largest_polygon(polygons: Column, least_area: float = 1.0, least_points: int = 3) -> Column:
    """The polygon of the largest area, the first among equals; null if none has enough points and area."""
    ranked = F.transform(F.filter(polygons, lambda p: n_points(p) >= least_points), lambda p, i: F.struct(area(p).alias("a"), (-i).alias("i"), p.alias("p")))
    best = F.array_max(F.transform(ranked, lambda r: F.struct(r["a"].alias("a"), r["i"].alias("i"))))
    found = F.get(F.filter(ranked, lambda r: (r["a"] == best["a"]) & (r["i"] == best["i"])), 0)
    return F.when(found["a"] >= least_area, found["p"])


def label_line(class_id: Column, flat: Column) -> Column:
    """A label as text: class, then coordinates with six decimals by the engine's rounding (see sinks.labels for C's)."""
    return F.concat_ws(" ", class_id.cast("string"), F.array_join(F.transform(flat, lambda v: F.format_string("%.6f", v)), " "))


def parsed_label(line: Column, least_tokens: int = 7) -> Column:
    """(class_id, poly) of a label's text; null with too few tokens."""
    tokens = F.split(F.trim(line), r"\s+")
    return F.when(F.size(tokens) >= least_tokens, F.struct(F.get(tokens, 0).cast("int").alias("class_id"), F.transform(F.slice(tokens, 2, F.size(tokens) - 1), lambda t: t.cast("double")).alias("poly")))
