"""Mixing sources to target weights by Poisson replication, in DataFrame expressions alone.

A source's rate is its target share of the total size over its own share, the mean number of times that
each of its documents should be seen. A document's count inverts the Poisson distribution of that mean at
a number in [0, 1) drawn by the md5 of seed and id; the document is exploded by its count, and all copies
are dealt out and ordered by another md5. Counts need no agreement between tasks and come out the same
however the rows are split. Sources of any size cost one partial sum for each task; nothing is sorted by source.

Edge cases. Null sources make one source. A null text has size 1, as has an empty one. Rows without an id draw
by their text. Repeated rows draw alike. A weight of zero drops a source; sources without a weight are
an error unless `rest` gives them one. An empty table gives no rows. Columns that clash with the
operator's own make its get an underscore in front.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import BROADCAST_ROWS, join_small, key_text, unit, unused

SEED = 20_240_301
#: Sizes to this power are the target weights where none are given: below 1 small sources gain.
TEMPERATURE = 0.7


def rates(docs: DataFrame, source_col: str = "source", text_col: str = "text", weights: dict[str | None, float] | None = None, rest: float | None = None, temperature: float = TEMPERATURE, epochs: float = 1.0) -> DataFrame:
    """(source_key, rate) for each source; the rate times the source's size is its target size, and these sum to epochs times the total."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1
    sources = docs.groupBy(key_text(F.col(source_col)).alias("source_key")).agg(F.sum(size).alias("size"))
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(float(temperature)))
    else:
        if any(not 0 <= w < math.inf for w in [*weights.values(), rest or 0]):
            raise ValueError("weights must be finite and at least 0")
        given = F.create_map(*[x for s, w in weights.items() for x in (F.lit("n" if s is None else f"v{s}"), F.lit(float(w)))]) if weights else F.create_map(F.lit(""), F.lit(0.0))
        other = F.raise_error(F.concat(F.lit("no weight for source "), "source_key")).cast("double") if rest is None else F.lit(float(rest))
        weight = F.coalesce(given[F.col("source_key")], other)
    sums = sources.select("source_key", "size", weight.alias("weight"))
    all_size, all_weight = sums.agg(F.sum("size")).scalar(), sums.agg(F.sum("weight")).scalar()
    rate = F.lit(float(epochs)) * F.col("weight") / all_weight * all_size / F.col("size")
    return sums.select("source_key", F.when(F.col("weight") > 0, rate).otherwise(F.lit(0.0)).alias("rate"))


def poisson_tables(rates: DataFrame) -> DataFrame:
    """rates with `cdf`: the Poisson distribution function at 0, 1, ... to far beyond the last that double precision tells from 1."""
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30)
    k = rates.select("source_key", "rate", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"))
    so_far = Window.partitionBy("source_key").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("k") > 0, F.log(F.col("rate")) - F.log(F.col("k").cast("double"))).otherwise(F.lit(0.0))
    mass = F.when(F.col("rate") > 0, F.exp(F.sum(step).over(so_far) - F.col("rate"))).otherwise(F.lit(1.0))
    k = k.withColumn("mass", mass).withColumn("upto", F.sum("mass").over(so_far))
    return k.groupBy("source_key").agg(F.first("rate").alias("rate"), F.transform(F.sort_array(F.collect_list(F.struct("k", "upto"))), lambda x: x["upto"]).alias("cdf"))


def counts(docs: DataFrame, rates: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, names: tuple[str, str] = ("rate", "n_copies")) -> DataFrame:
    """docs with each one's `rate` and Poisson count `n_copies`."""
    rate, n = unused(docs, *names)
    # A table of sources, broadcast only while it is small; the pattern of one rate is bounded by the rate.
    tables = poisson_tables(rates).select(F.col("source_key").alias("__source"), F.col("rate").alias(rate), F.col("cdf").alias("__cdf"))
    drawn = unit(F.lit(seed), *_identity(id_col, text_col))
    joined = join_small(docs.withColumn("__source", key_text(F.col(source_col))), tables, ["__source"], "inner", BROADCAST_ROWS // 10)
    return joined.withColumn("__u", drawn).withColumn(n, F.size(F.filter("__cdf", lambda c: c <= F.col("__u")))).select(*docs.columns, rate, n)


def _identity(id_col: str, text_col: str) -> tuple[Column, Column]:
    return F.col(id_col), F.when(F.col(id_col).isNull(), F.col(text_col))


def mix(docs: DataFrame, rates: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """docs replicated by their counts and shuffled globally, with `rate`, `n_copies`, `copy` (from 1) and `shuffle_key`.

    Each copy goes to a partition by the hash of its key and is ordered by the key there.
    """
    rate, n, copy, key = unused(docs, "rate", "n_copies", "copy", "shuffle_key")
    copies = counts(docs, rates, source_col, id_col, text_col, seed, (rate, n)).filter(F.col(n) > 0)
    copies = copies.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n))))
    copies = copies.withColumn(key, F.md5(key_text(F.lit(seed + 1), *_identity(id_col, text_col), F.col(copy))))
    return copies.repartition(key).sortWithinPartitions(key)
