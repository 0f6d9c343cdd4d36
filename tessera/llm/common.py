"""What the operators share: samples, text keys, draws and free names, and the tables and joins of the core."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.tables import BROADCAST_ROWS, fresh_dir, join_small, released, shared_dir, small, stored, stored_by

__all__ = ["BROADCAST_ROWS", "drawn", "fresh_dir", "join_small", "key_text", "released", "shared_dir", "small", "stored", "stored_by", "unit", "unused"]


def drawn(rows: DataFrame, key: Column, n: int) -> DataFrame:
    """At most n rows, those of the smallest hashes of the key: a draw by hash thins rows to little over n before any are sorted together."""
    share = min(1.0, (1.2 * n + 1000) / max(1, rows.count()))
    h = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    return rows.filter(h < F.lit(int(share * (1 << 40)))).orderBy(h, key).limit(n)


def key_text(*cols: Column) -> Column:
    """Text that tells rows apart, nulls included: each value after 'v', or 'n' for null."""
    return F.concat_ws("\x1f", *[F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), c.cast("string"))) for c in cols])


def unit(*cols: Column) -> Column:
    """A number in [0, 1) drawn by the md5 of the columns: 13 hex digits, the same in any engine."""
    return F.conv(F.substring(F.md5(key_text(*cols)), 1, 13), 16, 10).cast("long") / F.lit(float(16**13))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores put before those that df already has (in any case)."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out
