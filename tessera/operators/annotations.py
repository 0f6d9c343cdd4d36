"""Images and their annotations: filters, canonical categories, dense ids, merging, checks and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.strings import setup_key
from tessera.operators.ranking import range_bucket, ranked


def images_to_keep(annotations: DataFrame, image: str, label: str, keep: Sequence[str], drop: Sequence[str]) -> DataFrame:
    """Images with an annotation of a kept label and none of a dropped one: one pass of partial aggregates."""
    seen = annotations.filter(F.col(label).isin(*keep, *drop)).groupBy(image).agg(F.bool_or(F.col(label).isin(*keep)).alias("k"), F.bool_or(F.col(label).isin(*drop) if drop else F.lit(False)).alias("d"))
    return seen.filter("k and not d").select(image)


def keep_images(images: DataFrame, image: str, kept: DataFrame) -> DataFrame:
    return images.join(kept, image, "left_semi")


def keep_annotations(annotations: DataFrame, image: str, label: str, kept: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Annotations of kept labels on kept images."""
    return annotations.filter(F.col(label).isin(*keep)).join(kept, image, "left_semi")


def category_ids(keep: Sequence[str]) -> Column:
    """A map from label to its id: the position in the list, from 1; gaps stay where a label doesn't occur."""
    return F.create_map(*[x for i, k in enumerate(keep, 1) for x in (F.lit(k), F.lit(i))])


def class_index(classes: Sequence[str], label: Column) -> Column:
    """A label's position in the list from 0; null for others."""
    return F.create_map(*[x for i, k in enumerate(classes) for x in (F.lit(k), F.lit(i))])[label]


def renumber(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows with ids 1, 2, ... in an order whose first column is a number; sorted in ranges, not in one task."""
    return ranked(rows, [F.col(c) for c in order], range_bucket(rows, F.col(order[0]).cast("double")), name)


def canonical(images: DataFrame, annotations: DataFrame, image: str, order: list[str], label: str, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Images and annotations renumbered densely; annotations get new image ids and category ids, those of other images go."""
    numbered = renumber(images, [image], "new_image_id")
    ids = category_ids(keep)
    rows = annotations.join(numbered.select(image, "new_image_id"), image).withColumn("new_category_id", ids[F.col(label)])
    rows = rows.filter(F.col("new_category_id").isNotNull())
    return numbered, renumber(rows, ["new_image_id", *order], "new_annotation_id")


def merged(parts: Sequence[DataFrame], order: list[str], export: str = "export_no", name: str = "new_id") -> DataFrame:
    """All exports' rows under dense ids, by export, then by the order within."""
    rows = [p.withColumn(export, F.lit(i)) for i, p in enumerate(parts)]
    out = rows[0]
    for p in rows[1:]:
        out = out.unionByName(p)
    return dense(out, order, export, name)


def dense(rows: DataFrame, order: list[str], export: str = "export_no", name: str = "new_id") -> DataFrame:
    """rows of several exports under dense ids, by export, then by an order whose first column is a number; an export is sorted in ranges, not in one task."""
    at = ranked(rows, [F.col(c) for c in order], range_bucket(rows, F.col(order[0]).cast("double")), "__at", (export,))
    return _after_groups(at, export, name)


def _after_groups(rows: DataFrame, group: str, name: str) -> DataFrame:
    """Positions in groups made global: those of earlier groups are added; the groups are exports, which are few."""
    n = rows.groupBy(group).agg(F.count("*").alias("__n"))
    before = n.select(F.col(group), F.coalesce(F.sum("__n").over(Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return rows.join(before, group).withColumn(name, F.col("__at") + F.col("__before")).drop("__at", "__before")


def canonical_categories(categories: DataFrame, export: str, category: str, label: str) -> DataFrame:
    """(export, category, canonical id) by the label's id in the first export; labels that it lacks are an error."""
    first = categories.filter(F.col(export) == categories.agg(F.min(export)).scalar()).select(F.col(label).alias("__label"), F.col(category).alias("canonical_id"))
    joined = categories.join(first, F.col(label) == F.col("__label"), "left")
    return joined.select(export, category, F.coalesce("canonical_id", F.raise_error(F.concat(F.lit("not in the first export: "), F.col(label))).cast("long")).alias("canonical_id"))


def missing_labels(present: DataFrame, label: str, required: Sequence[str], group: str | None = None) -> DataFrame:
    """Required labels that don't occur, in each group."""
    need = F.explode(F.array(*[F.lit(r) for r in required])).alias(label)
    wanted = present.select(group).distinct().select(group, need) if group else present.sparkSession.range(1).select(need)
    return wanted.join(present.select(*([group] if group else []), label).distinct(), [*([group] if group else []), label], "left_anti")


def require(problem: DataFrame, message: str) -> None:
    """An error with a few examples if there are any rows."""
    if rows := problem.limit(5).collect():
        raise ValueError(f"{message}: {', '.join(str(tuple(r)) for r in rows)}")


def collisions(rows: DataFrame, key: str, export: str) -> DataFrame:
    """Keys that occur in several exports, with these."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(export)).alias("exports")).filter(F.size("exports") > 1)


def setup_pairs(images: DataFrame, export: str, stem: str, ends: Sequence[str] = ("_Color", "_empty")) -> DataFrame:
    """(export, setup, paired) of each setup: whether it has an image of either end, the scene and its empty twin."""
    setup = setup_key(F.col(stem))
    seen = [F.bool_or(F.col(stem).endswith(e)) for e in ends]
    return images.groupBy(export, setup.alias("setup")).agg((seen[0] & seen[1]).alias("paired"))


def with_annotations(images: DataFrame, annotations: DataFrame, image: str, order: str, columns: Sequence[str], name: str = "annotations") -> DataFrame:
    """Images with their annotations as an array in order, empty without any."""
    lists = annotations.groupBy(image).agg(F.sort_array(F.collect_list(F.struct(order, *[c for c in columns if c != order]))).alias(name))
    return images.join(lists, image, "left").withColumn(name, F.coalesce(F.col(name), F.array().cast(lists.schema[name].dataType)))


def positives(images: DataFrame, annotations: DataFrame, image: str, name: str = "positive") -> DataFrame:
    """Images with a mark whether they have an annotation."""
    marks = annotations.groupBy(image).agg(F.lit(True).alias(name))
    return images.join(marks, image, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def positive_counts(marked: DataFrame, split: str, positive: str = "positive") -> DataFrame:
    return marked.groupBy(split).agg(F.count_if(F.col(positive)).alias("n_pos"), F.count_if(~F.col(positive)).alias("n_neg"))


def class_counts(annotations: DataFrame, label: str, split: str) -> DataFrame:
    return annotations.groupBy(split, label).agg(F.count("*").alias("n"))


def valid_segmentation(polygons: Column) -> Column:
    """Whether there is a first polygon that isn't empty."""
    return F.coalesce((F.size(polygons) > 0) & (F.size(F.get(polygons, 0)) > 0), F.lit(False))
