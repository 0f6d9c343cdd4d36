"""Positions in a global order, or in groups of any size, without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Most buckets, and rows in one while there are fewer.
BUCKETS, BUCKET_ROWS = 1024, 250_000


def hash_number(*cols: Column) -> Column:
    """52 bits of the md5 of the values joined by colons; orders rows at random."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[c.cast("string") for c in cols])), 1, 13), 16, 10).cast("long")


def hash_bucket(number: Column, buckets: int = BUCKETS) -> Column:
    return F.floor(number / F.lit(2**52 // buckets))


def range_bucket(df: DataFrame, column: Column, buckets: int = BUCKETS, rows: int = BUCKET_ROWS) -> Column | None:
    """A bucket by ranges of a numeric column, of about `rows` rows, or more beyond `buckets`; only bounds reach the driver. None if one is enough for all rows."""
    n = df.count()
    wanted = min(buckets, n // rows + 1)
    if wanted == 1:
        return None
    at = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    bounds = df.agg(F.percentile_approx(column, at, F.lit(4 * buckets))).first()[0]
    return _bisected(column, sorted({bounds[i * buckets // wanted - 1] for i in range(1, wanted)} if bounds else []))


def _bisected(column: Column, bounds: list, below: int = 0) -> Column:
    """How many of the sorted bounds lie under the value, by halving; 0 for null, which sorts first."""
    if not bounds:
        return F.lit(below).cast("long")
    mid = len(bounds) // 2
    return F.when(column > bounds[mid], _bisected(column, bounds[mid + 1 :], below + mid + 1)).otherwise(_bisected(column, bounds[:mid], below))


def ranked(df: DataFrame, order: list[Column | str], bucket: Column | None, name: str, group: tuple[str, ...] = (), size: str | None = None, weight: Column | None = None) -> DataFrame:
    """df with each row's position (from 1) in its group's order, and if wanted the group's size.

    With a weight, a row counts that often: its position is the sum up to and with it. bucket must grow with the order.
    Rows are sorted within a bucket of a group only; the counts of earlier buckets are added. Without groups that is one
    row for each bucket in one task. Without a bucket, for rows that one task may sort, groups are sorted whole.
    """
    if bucket is None:
        whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
        inside = whole.orderBy(*order)
        place = F.row_number().over(inside).cast("long") if weight is None else F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, 0))
        more = [(F.count("*") if weight is None else F.sum(weight)).over(whole).alias(size)] if size else []
        return df.select("*", place.alias(name), *more)
    rows = df.withColumn("__bucket", bucket)
    keys = [*group, "__bucket"]
    n = rows.groupBy(*keys).agg((F.count("*") if weight is None else F.sum(weight)).alias("__n"))
    upto = Window.partitionBy(*group).orderBy("__bucket")
    n = n.withColumn("__before", F.coalesce(F.sum("__n").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    n = n.withColumn("__size", F.sum("__n").over(Window.partitionBy(*group))).drop("__n")
    n = n.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__before", "__size")
    on = None
    for i, k in enumerate(keys):
        same = F.col(k).eqNullSafe(F.col(f"__k{i}"))
        on = same if on is None else on & same
    inside = Window.partitionBy(*keys).orderBy(*order)
    place = (F.row_number().over(inside) if weight is None else F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, 0))) + F.col("__before")
    more = [F.col("__size").alias(size)] if size else []
    return rows.join(n, on).select(*[F.col(f"`{c}`") for c in df.columns], place.alias(name), *more)
