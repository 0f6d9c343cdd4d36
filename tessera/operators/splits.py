"""Train, validation and test splits by key: at random by hash, or exactly as a sequential generator deals them.

The hash method orders keys by md5(seed:key), ties by key, and gives the first to the first split. It needs no agreement
between tasks. The exact method shuffles keys on the driver with a Mersenne Twister that goes on from group to
group; keys of splits are few (setups, files), and MAX_KEYS bounds them.
"""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numbers import share
from tessera.operators.ranking import hash_bucket, hash_number, ranked

MAX_KEYS = 200_000
TOLERANCE = 1e-6


def check_ratios(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1) > TOLERANCE:
        raise ValueError("the ratios must sum to 1")
    if min(val, test) < 0 or not 0 < train <= 1:
        raise ValueError("the train ratio must be over 0, the others not below")


def per_export(values: list[int], n_exports: int) -> list[int]:
    """One value for all exports, or one for each."""
    if len(values) == 1:
        return values * n_exports
    if len(values) != n_exports:
        raise ValueError(f"1 or {n_exports} values are needed, not {len(values)}")
    return list(values)


def fixed_split(keys: DataFrame, group: str | None, key: str, n_val: int | Column, n_test: int | Column, seed: int, name: str = "split") -> DataFrame:
    """keys with a split: by hash order in each group, n_val to val, then n_test to test, the rest to train."""
    order = _placed(keys, group, key, seed)
    val = F.greatest(F.lit(0), F.least(F.lit(n_val) if isinstance(n_val, int) else n_val, F.col("__n")))
    test = F.greatest(F.lit(0), F.least(F.lit(n_test) if isinstance(n_test, int) else n_test, F.col("__n") - val))
    split = F.when(F.col("__r") <= val, "val").when(F.col("__r") <= val + test, "test").otherwise("train")
    return order.withColumn(name, split).drop("__r", "__n")


def ratio_split(keys: DataFrame, group: str | None, key: str, first: tuple[str, float], second: tuple[str, float], rest: str, seed: int, name: str = "split") -> DataFrame:
    """keys with a split by ratio, halves rounded to even: the first split's share, the second's, the rest."""
    order = _placed(keys, group, key, seed)
    a, b = share(F.col("__n"), first[1]), share(F.col("__n"), second[1])
    split = F.when(F.col("__r") <= a, first[0]).when(F.col("__r") <= a + b, second[0]).otherwise(rest)
    return order.withColumn(name, split).drop("__r", "__n")


def train_first(keys: DataFrame, key: str, val: float, test: float, seed: int, group: str | None = None) -> DataFrame:
    """Split in the order train, val, test; train gets what the rounded shares of the others leave."""
    order = _placed(keys, group, key, seed)
    n_val, n_test = share(F.col("__n"), val), share(F.col("__n"), test)
    n_train = F.col("__n") - n_val - n_test
    split = F.when(F.col("__r") <= n_train, "train").when(F.col("__r") <= n_train + n_val, "val").otherwise("test")
    return order.withColumn("split", split).drop("__r", "__n")


def _placed(keys: DataFrame, group: str | None, key: str, seed: int) -> DataFrame:
    number = hash_number(F.lit(seed), F.col(key))
    order = [F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), F.col(key)]
    return ranked(keys, order, hash_bucket(number), "__r", (group,) if group else (), "__n")


def _dealt(groups: dict[str, list[str]], sizes, order: tuple[str, str, str], generator: random.Random) -> list[tuple[str, str, str]]:
    out = []
    for group, keys in groups.items():
        keys = sorted(keys)
        generator.shuffle(keys)
        counts = sizes(group, len(keys))
        at = 0
        for split in order:
            n = counts.get(split, len(keys) - at)
            out += [(group, k, split) for k in keys[at : at + n]]
            at += n
    return out


def exact_fixed(groups: dict[str, Iterable[str]], n_val: list[int], n_test: list[int], seed: int = 42) -> list[tuple[str, str, str]]:
    """(group, key, split) as one generator deals them: keys in string order, shuffled, val first, then test, then train."""
    names = list(groups)

    def sizes(group: str, n: int) -> dict[str, int]:
        i = names.index(group)
        val = max(0, min(n_val[i], n))
        return {"val": val, "test": max(0, min(n_test[i], n - val))}

    return _dealt({g: list(k) for g, k in groups.items()}, sizes, ("val", "test", "train"), random.Random(seed))


def exact_ratio(groups: dict[str, Iterable[str]], val: float, test: float, seed: int = 42, train_first: bool = False) -> list[tuple[str, str, str]]:
    """(group, key, split) by ratio; in the order val, test, train, or train, val, test."""

    def sizes(_: str, n: int) -> dict[str, int]:
        a, b = round(n * val), round(n * test)
        return {"train": n - a - b, "val": a, "test": b} if train_first else {"val": a, "test": b}

    order = ("train", "val", "test") if train_first else ("val", "test", "train")
    return _dealt({g: list(k) for g, k in groups.items()}, sizes, order, random.Random(seed))


def keys_by_group(df: DataFrame, group: str | Column, key: str) -> dict[str, list[str]]:
    """The distinct keys of each group on the driver, groups in order; an error beyond MAX_KEYS."""
    rows = df.select((F.col(group) if isinstance(group, str) else group).cast("string").alias("g"), F.col(key).cast("string").alias("k")).distinct().limit(MAX_KEYS + 1).collect()
    if len(rows) > MAX_KEYS:
        raise ValueError(f"over {MAX_KEYS} keys: use the hash method")
    out: dict[str, list[str]] = {}
    for g, k in sorted((r["g"] or "", r["k"] or "") for r in rows):
        out.setdefault(g, []).append(k)
    return out


def assignment(df: DataFrame, dealt: list[tuple[str, str, str]], group: str, key: str, name: str = "split") -> DataFrame:
    """df with the split dealt to its group and key, broadcast within MAX_KEYS."""
    if len(dealt) > MAX_KEYS:
        raise ValueError(f"over {MAX_KEYS} keys: use the hash method")
    table = df.sparkSession.createDataFrame(dealt, f"__g string, __k string, {name} string")
    return df.join(F.broadcast(table), (F.col(group).cast("string") == F.col("__g")) & (F.col(key).cast("string") == F.col("__k")), "left").drop("__g", "__k")


def attach(rows: DataFrame, splits: DataFrame, key: str, split: str = "split", default: str | None = "train") -> DataFrame:
    """rows with their key's split; keys without one get the default, or are an error if it is None."""
    joined = rows.join(splits.select(key, split), key, "left")
    missing = F.lit(default) if default is not None else F.raise_error(F.concat(F.lit("no split for "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return joined.withColumn(split, F.coalesce(F.col(split), missing))


def without_split(rows: DataFrame, splits: DataFrame, key: str) -> DataFrame:
    """The keys of rows that have no split."""
    return rows.select(key).distinct().join(splits.select(key), key, "left_anti")


def counts_by_split(assigned: DataFrame, split: str = "split", name: str = "n") -> DataFrame:
    return assigned.groupBy(split).agg(F.count("*").alias(name))


def starved(assigned: DataFrame, group: str, split: str = "split") -> DataFrame:
    """Groups that have no key left to train on."""
    return assigned.groupBy(group).agg(F.count_if(F.col(split) == "train").alias("n_train")).filter("n_train = 0").select(group)
