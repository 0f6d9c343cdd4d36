"""Sharding by proportional stratified interleaving, in DataFrame expressions alone.

Within each source rows are ordered by a seeded hash of all their columns, the id first; the row of rank r among n gets the fractional rank
(r + 0.5) / n. All rows sorted by fractional rank interleave the sources in proportion, and cutting that order
into equal pieces gives every shard the mixture and row counts at most one apart.

No rank is taken in one task: rows are ranked within a hash bucket of a source, or a range of the
fractional rank, and the sums of the buckets before are added. A source with a third of all rows is spread over all
of its buckets.

Edge cases. Null sources make one source. Null ids and texts are ordered like any value; rows without an id, or with the same
one, are spread by their other columns. Rows equal in every column are interchangeable, so their order makes no difference; they share a bucket. Shards beyond the number of rows stay empty.
An empty table gives no rows. Columns that clash with the operator's own make its get an underscore in front.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import key_text, unused

SEED = 20_240_302
#: Hash buckets of a source, and ranges of the fractional rank.
BUCKETS = 4096


def interleave(docs: DataFrame, n_shards: int, source_col: str = "source", id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """docs with `shard` (from 0) and `slot` (from 0 without gaps, in the interleaved order)."""
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    shard, slot = unused(docs, "shard", "slot")
    # Rows that agree in id are told apart by all other columns that have an order, and so dealt to different buckets.
    ties = [c for c, t in docs.dtypes if c != id_col and not t.startswith("map") and t != "variant"]
    h = F.conv(F.substring(F.md5(key_text(F.lit(seed), F.col(id_col), *[F.col(c) for c in ties])), 1, 13), 16, 10).cast("long")
    rows = docs.withColumns({"__source": key_text(F.col(source_col)), "__h": h}).withColumn("__bucket", F.floor(F.col("__h") / F.lit(2**52 // BUCKETS)))

    n = rows.groupBy("__source", "__bucket").agg(F.count("*").alias("__n"))
    upto = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = n.select("__source", "__bucket", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy("__source")).alias("__size"))
    rank = F.row_number().over(Window.partitionBy("__source", "__bucket").orderBy("__h", id_col, *ties)) - 1 + F.col("__before")
    ranked = rows.join(before.hint("merge"), ["__source", "__bucket"]).withColumn("__frac", (rank + 0.5) / F.col("__size")).withColumn("__range", F.floor(F.col("__frac") * BUCKETS))

    # Rows in a range of fractional ranks follow from the sources' sizes, without ranking any.
    sizes = n.groupBy("__source").agg(F.sum("__n").alias("__size"))
    spread = _range_counts(sizes)
    order = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = spread.select("__range", F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__ahead"))
    ahead = F.broadcast(ahead.withColumn("__all", sizes.agg(F.sum("__size")).scalar()))  # at most BUCKETS rows

    place = F.row_number().over(Window.partitionBy("__range").orderBy("__frac", "__source")) - 1 + F.col("__ahead")
    placed = ranked.join(ahead, "__range").withColumn("__place", place)
    cut = F.expr(f"(__place * {n_shards}) div __all")
    start = F.expr(f"(__shard * __all + {n_shards} - 1) div {n_shards}")
    return placed.withColumn("__shard", cut).withColumn("__start", start).select(*docs.columns, F.col("__shard").cast("int").alias(shard), (F.col("__place") - F.col("__start")).alias(slot))


def _range_counts(sizes: DataFrame) -> DataFrame:
    """(__range, __n): how many rows of all sources have their fractional rank in each range.

    A source of n rows has floor(f(k + 1)) - floor(f(k)) in range k, counted by the same division as the ranks:
    small sources row by row, sources of over BUCKETS rows by their number below each bound.
    """
    few = sizes.filter(F.col("__size") <= BUCKETS).withColumn("__r", F.explode(F.expr("sequence(0L, __size - 1)")))
    few = few.select(F.floor((F.col("__r") + 0.5) / F.col("__size") * BUCKETS).alias("__range"), F.lit(1).cast("long").alias("__n"))

    def below(k):
        """Ranks r with floor((r + 0.5) / n * BUCKETS) < k; the quotient is corrected by one where rounding moved it."""
        near = F.ceil(k * F.col("__size") / F.lit(float(BUCKETS)) - 0.5)
        of = lambda r: F.floor((r + 0.5) / F.col("__size") * BUCKETS)
        return F.when((near > 0) & (of(near - 1) >= k), near - 1).when((near < F.col("__size")) & (of(near) < k), near + 1).otherwise(near)

    many = sizes.filter(F.col("__size") > BUCKETS).withColumn("__range", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(BUCKETS - 1).cast("long"))))
    many = many.select("__range", (below(F.col("__range") + 1) - below(F.col("__range"))).alias("__n"))
    return few.unionByName(many).groupBy("__range").agg(F.sum("__n").alias("__n"))
