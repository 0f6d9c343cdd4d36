"""Label files, manifests, dataset descriptions and annotation documents."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sinks.files import write_files


@F.arrow_udf(T.StringType())
def c_label(class_id: pa.Array, flat: pa.Array) -> pa.Array:
    """A label's line with six decimals as C's printf rounds them; null without a polygon. format_string rounds decimal halves up, C the binary value, so this is Python, in Arrow batches."""
    return pa.array([None if f is None else " ".join([str(c), *("%.6f" % v for v in f)]) for c, f in zip(class_id.to_pylist(), flat.to_pylist(), strict=True)], pa.string())


@F.arrow_udf(T.StringType())
def c_seconds(seconds: pa.Array) -> pa.Array:
    """Seconds with two decimals as C's printf rounds them."""
    return pa.array([None if s is None else "%.2f" % s for s in seconds.to_pylist()], pa.string())


def label_texts(images: DataFrame, labels: DataFrame, stem: str, order: str, class_id: str, poly: str) -> DataFrame:
    """images with `label`: a line for each label in order, an empty text for an image without any."""
    lines = labels.select(stem, order, c_label(F.col(class_id), F.col(poly)).alias("line")).filter("line is not null")
    texts = lines.groupBy(stem).agg(F.sort_array(F.collect_list(F.struct(order, "line"))).alias("l"))
    text = F.concat_ws("", F.transform("l", lambda x: F.concat(x["line"], F.lit("\n"))))
    return images.join(texts, stem, "left").withColumn("label", F.coalesce(text, F.lit(""))).drop("l")


def write_labels(texts: DataFrame, root: str, split: str, stem: str, mode: str = "overwrite") -> DataFrame:
    """One file labels/<split>/<stem>.txt for each image."""
    return write_files(texts, root, F.concat(F.lit("labels/"), split, F.lit("/"), stem, F.lit(".txt")), F.col("label"), mode)


def dataset_yaml(names: Sequence[str] | dict[int, str], root: str | None = None, train: str = "images/train", val: str = "images/val", test: str = "images/test") -> str:
    """A dataset's description; an evaluation set names its test folder three times."""
    ids = names if isinstance(names, dict) else dict(enumerate(names))
    lines = [f"path: {root}"] if root else []
    lines += [f"train: {train}", f"val: {val}", f"test: {test}", "names:", *(f"  {i}: {n}" for i, n in sorted(ids.items()))]
    return "\n".join(lines) + "\n"


def write_manifests(assigned: DataFrame, root: str, split: str, name: str) -> DataFrame:
    """splits/<split>.txt with one file name a line, sorted."""
    lists = assigned.groupBy(split).agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(name)), lambda n: F.concat(n, F.lit("\n")))).alias("text"))
    return write_files(lists, root, F.concat(F.lit("splits/"), split, F.lit(".txt")), F.col("text"), "overwrite")


def source_index_json(stems: DataFrame, groups: DataFrame) -> DataFrame:
    """One row: the index as JSON, keys and lists sorted."""
    pairs = lambda df, k, v: F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v))))
    a = stems.agg(pairs(stems, *stems.columns[:2]).alias("stem_to_source")).withColumn("one", F.lit(1))
    b = groups.agg(pairs(groups, *groups.columns[:2]).alias("source_to_component_stems")).withColumn("one", F.lit(1))
    return a.join(b, "one").select(F.to_json(F.struct("stem_to_source", "source_to_component_stems")).alias("value"))


def coco_json(images: DataFrame, annotations: DataFrame, categories: DataFrame, info: Column | None = None, licenses: Column | None = None) -> DataFrame:
    """One row: a whole annotation document as indented JSON, its lists ordered by id.

    A document is one value, so this is for exports, not for tables of any size; those stay tables.
    """

    def listed(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.sort_array(F.collect_list(F.struct("id", *[c for c in df.columns if c != "id"]))).alias(name)).withColumn("one", F.lit(1))

    doc = listed(images, "images").join(listed(annotations, "annotations"), "one").join(listed(categories, "categories"), "one")
    more = [c.alias(n) for n, c in (("info", info), ("licenses", licenses)) if c is not None]
    return doc.select(F.to_json(F.struct(*more, "images", "annotations", "categories"), {"pretty": "true"}).alias("value"))


def augmentation_log(rows: DataFrame, summary: DataFrame, args: dict[str, object], where: dict[str, str], sizes: DataFrame | None = None) -> DataFrame:
    """One row: a run's log as JSON, with its time, arguments, folders, sizes by class, written variants in order and counters.

    sizes has (class, n_samples, median_area, p05_area, p95_area). A log is one document and so one value.
    """
    images = rows.agg(F.sort_array(F.collect_list(F.struct("augmented_image", *[c for c in rows.columns if c != "augmented_image"]))).alias("augmented_images"), F.lit(1).alias("one"))
    both = images.join(summary.select(F.struct(*summary.columns).alias("summary"), F.lit(1).alias("one")), "one")
    if sizes is not None:
        each = F.struct(F.col(sizes.columns[0]).cast("string"), F.struct("n_samples", *[F.col(c).alias(f"{c}_px") for c in ("median_area", "p05_area", "p95_area")]))
        both = both.join(sizes.agg(F.map_from_entries(F.sort_array(F.collect_list(each))).alias("target_areas_per_class"), F.lit(1).alias("one")), "one")
    else:
        both = both.withColumn("target_areas_per_class", F.expr("cast(map() AS map<string, string>)"))
    parsed = lambda v: F.parse_json(F.lit(json.dumps(v)))
    doc = F.struct(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.lit("Paths are relative to the folder of this file.").alias("_paths_note"),
        parsed(where).alias("_absolute_at_write_time"),
        parsed(args).alias("args"),
        "target_areas_per_class",
        "augmented_images",
        "summary",
    )
    return both.select(F.to_json(doc, {"pretty": "true"}).alias("value"))


#: What a mask bank's manifest says of a clip, in this order (fixed names).
MANIFEST = ("video_filename", "component_id", "reseat_idx", "output_dir", "video_resolution_wh", "n_frames_extracted", "n_masks_saved", "first_frame_click", "attempts_to_accept")


def mask_manifest(clips: DataFrame, where: dict[str, str], args: dict[str, object]) -> DataFrame:
    """One row: a mask bank's manifest as one JSON document, its clips (columns MANIFEST) by file name."""
    videos = clips.agg(F.sort_array(F.collect_list(F.struct(*MANIFEST))).alias("videos"))
    parsed = lambda v: F.parse_json(F.lit(json.dumps(v)))
    doc = F.struct(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("created_at"), F.lit("Paths are relative to the folder of this file.").alias("_paths_note"), parsed(where).alias("_absolute_at_write_time"), parsed(args).alias("args"), "videos")
    return videos.select(F.to_json(doc, {"pretty": "true"}).alias("value"))
