"""Files as tables: finding images, pairs of files, splits from folders, and work that is done already."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.strings import base_name, has_suffix, rgb_of_mask, stem

#: Folders in which an image is looked for, in order; {} is the file's name (fixed values).
EXPORT_ORDER = ("images/{}", "images/default/{}", "images/Test/{}", "{}")
PLAIN_ORDER = ("{}", "images/{}", "data/{}", "images/default/{}")
SPLITS = ("train", "val", "test")


def locate(wanted: DataFrame, name: str, files: DataFrame, path: str, order: Sequence[str] = EXPORT_ORDER, found: str = "path") -> DataFrame:
    """wanted with the path of each name's file, null without one: by the order of folders, then the smallest path.

    files holds paths relative to the export, listed once; names are joined by their last part.
    """
    listed = files.select(F.col(path).alias("__path"), base_name(F.col(path)).alias("__base"))
    rows = wanted.select(name).distinct().withColumn("__base", base_name(F.col(name))).join(listed, "__base")
    rank = F.lit(len(order))
    for i, form in reversed(list(enumerate(order))):
        head, tail = form.split("{}")
        rank = F.when(F.col("__path") == F.concat(F.lit(head), F.col(name), F.lit(tail)), i).otherwise(rank)
    best = rows.groupBy(name).agg(F.min_by("__path", F.struct(rank, F.col("__path"))).alias(found))
    return wanted.join(best, name, "left")


def first_by_rank(rows: DataFrame, key: list[str], value: Column, rank: Column, name: str) -> DataFrame:
    """Of each key the value of the smallest rank, ties to the smallest value."""
    return rows.groupBy(*key).agg(F.min_by(value, F.struct(rank, value)).alias(name))


def last_by_rank(rows: DataFrame, key: list[str], value: Column, rank: Column, name: str) -> DataFrame:
    """Of each key the value of the largest rank: the last one wins."""
    return rows.groupBy(*key).agg(F.max_by(value, F.struct(rank, value)).alias(name))


def splits_from_folders(files: DataFrame, path: str, key: Column, splits: Sequence[str] = SPLITS) -> DataFrame:
    """(key, split) by the folders images/<split>/ that files lie in; of several splits the last counts."""
    split = F.regexp_extract(F.col(path), r"(?:^|/)images/([^/]+)/[^/]+$", 1)
    rows = files.filter(has_suffix(F.col(path))).select(key.alias("key"), split.alias("split")).filter(F.col("split").isin(*splits))
    order = F.array_position(F.array(*[F.lit(s) for s in splits]), F.col("split"))
    return last_by_rank(rows, ["key"], F.col("split"), order, "split")


def mask_pairs(files: DataFrame, path: str) -> DataFrame:
    """(component, clip, frame, rgb_path, mask_path) of masks component/clip/*_mask.png with their image beside them."""
    masks = files.filter(F.col(path).rlike(r"(?:^|/)[^/]+/[^/]+/[^/]+_mask\.png$")).select(F.col(path).alias("mask_path"), rgb_of_mask(F.col(path)).alias("rgb_path"))
    pairs = masks.join(files.select(F.col(path).alias("rgb_path")), "rgb_path", "left_semi")
    part = F.split("rgb_path", "/")
    return pairs.select(F.element_at(part, -3).alias("component"), F.element_at(part, -2).alias("clip"), stem(F.col("rgb_path")).alias("frame"), "rgb_path", "mask_path")


def to_do(work: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Work that isn't done."""
    return work.join(done.select(*key).distinct(), key, "left_anti")


def source_index(stems: DataFrame, stem_col: str, group: str, order: Column) -> tuple[DataFrame, DataFrame]:
    """(stem, group), the last group of a stem in order, and (group, stems) sorted.

    The second is the index as its document has it: a group's stems are one value, in one task. For groups of any size use the first.
    """
    of_stem = last_by_rank(stems, [stem_col], F.col(group), order, group)
    return of_stem, of_stem.groupBy(group).agg(F.array_sort(F.collect_list(stem_col)).alias("stems"))
