"""Tables in the folder that all executors share, and joins that look at sizes."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The most rows that are ever sent to all executors.
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir.

    Only a local session, as in tests, may have none; then it gets a temporary one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.conf.get("tessera.shared.dir", None) is None:
        spark.conf.set("tessera.shared.dir", "file://" + tempfile.mkdtemp(prefix="tessera-"))
    return spark.conf.get("tessera.shared.dir")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"


#: Bytes of an Arrow batch on its way to Python while a table is stored. By rows alone, batches of texts take several times that, off the heap.
ARROW_BYTES = "8m"


@contextmanager
def _bounded_batches(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, ARROW_BYTES)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read back: cuts the lineage and outlives lost executors."""
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, name)
    with _bounded_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """df stored in as many buckets of the key as the session has shuffle partitions: joins and groups by the key read it without a shuffle.

    Tasks write the buckets of their rows without a shuffle either, so this is for rows of megabytes: there may be a file for each.
    """
    spark, path, table = df.sparkSession, fresh_dir(df.sparkSession, name), f"tessera_{uuid.uuid4().hex}"
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    df.write.option("compression", "zstd").option("path", path).bucketBy(n, key).saveAsTable(table)
    out = spark.table(table)
    out.schema  # resolved now: the catalogue needn't keep a table whose files only this run reads
    spark.sql(f"DROP TABLE {table}")
    return out


def released(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of what was stored and isn't referred to any more, which it does when the driver collects garbage.

    Twice, as the listeners of a query that has just ended may hold it a moment longer.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.1)
    spark.sparkContext._jvm.System.gc()


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most so many rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def join_small(big: DataFrame, side: DataFrame, on: list[str], how: str = "left", rows: int = BROADCAST_ROWS) -> DataFrame:
    """big joined with side: broadcast only after counting side's rows, else shuffled, where Spark splits skewed keys."""
    return big.join(F.broadcast(side) if small(side, rows) else side.hint("merge"), on, how)
