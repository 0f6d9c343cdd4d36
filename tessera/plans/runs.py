"""Runs from sources to tables: what each writes is left to the sinks."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import numbers, polygons, strings
from tessera.operators import annotations as A
from tessera.operators import layout, sampling, splits, stats
from tessera.raster.augment import rle_polygon
from tessera.sources import coco
from tessera.tables import join_small

#: Component classes by position, and the label of the area that pastes go to (fixed values).
CLASSES = ("screw", "nut", "gear")
REGION = "platform"


class Dataset(NamedTuple):
    """images with split and source group; labels normalised; regions: images with the polygons to paste into."""

    images: DataFrame
    labels: DataFrame
    regions: DataFrame


def extract_frames(messages: DataFrame, recording: str, time_ns: str, tie: str, stride_s: float = 2.0, start_skip_s: float = 0.0, skip_end_s: float = 2.0) -> DataFrame:
    """Sampled frames of recordings with `sample_no`, `hundredths` of a second from the start, and the file's name."""
    start, end = numbers.s_to_ns(start_skip_s), numbers.s_to_ns(skip_end_s)
    first = sampling.durations(messages, recording, time_ns).select(recording, "first_time", "duration")
    A.require(first.filter(F.col("duration") <= start + end).select(recording), "nothing is left between the skips of")
    kept = sampling.trim(messages, recording, time_ns, start, end).join(first.select(recording, "first_time"), recording)
    frames = sampling.stride_sample(kept, recording, time_ns, tie, numbers.s_to_ns(stride_s), F.col("first_time") + start)
    frames = frames.withColumn("hundredths", F.round((F.col(time_ns) - F.col("first_time")) / 1e7).cast("long")).drop("first_time")
    return frames.withColumn("file_name", strings.frame_name(F.col(recording).cast("string"), F.col("sample_no"), F.col("hundredths")))


def _labelled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Images of all exports, and their annotations with the label's name and first polygon."""
    images, anns, cats = coco.images(docs), coco.annotations(docs), coco.categories(docs)
    named = cats.select("export_no", F.col("id").alias("category_id"), F.col("name").alias("label"))
    rows = join_small(anns.filter(A.valid_segmentation(F.col("polygons"))), named, ["export_no", "category_id"], "inner")
    return images, rows.select("export_no", F.col("image_id"), F.col("id").alias("ann_id"), F.col("pos").alias("ann_pos"), "label", "area", "bbox", polygons.first_polygon(F.col("polygons")).alias("poly"))


def check_exports(docs: DataFrame) -> None:
    """All labels there, and no setup in two exports; an error otherwise."""
    cats = coco.categories(docs)
    A.require(A.missing_labels(cats, "name", (*CLASSES, REGION), "export_no"), "labels are missing")
    setups = coco.images(docs).select("export_no", strings.setup_key(strings.stem(F.col("file_name"))).alias("setup")).distinct()
    A.require(A.collisions(setups, "setup", "export_no"), "setups are in several exports")


def unpaired(docs: DataFrame) -> DataFrame:
    """(export_no, setup) of setups that lack an image of either kind."""
    images = coco.images(docs).withColumn("stem", strings.stem(F.col("file_name")))
    return A.setup_pairs(images, "export_no", "stem").filter("not paired").select("export_no", "setup")


def dataset(docs: DataFrame, split_of: DataFrame, key: Column, group: Column, default: str | None = "train") -> Dataset:
    """Exports as one dataset: split_of has (key, split) for the keys that images get by `key`."""
    images, anns = _labelled(docs)
    images = images.withColumns({"stem": strings.stem(F.col("file_name")), "key": key, "source": group})
    images = splits.attach(images, split_of, "key", default=default)
    size = images.select("export_no", F.col("id").alias("image_id"), "stem", "split", "width", "height")
    rows = anns.join(size, ["export_no", "image_id"])
    labels = rows.withColumn("class_id", A.class_index(CLASSES, F.col("label"))).filter("class_id is not null")
    labels = labels.select("split", "stem", "export_no", "ann_pos", "class_id", polygons.normalized(F.col("poly"), F.col("width"), F.col("height")).alias("poly"))
    inside = rows.filter((F.col("label") == REGION) & (polygons.n_points(F.col("poly")) >= 3))
    regions = inside.groupBy("split", "stem").agg(F.first("width").alias("width"), F.first("height").alias("height"), F.transform(F.sort_array(F.collect_list(F.struct("ann_pos", "poly"))), lambda s: s["poly"]).alias("polygons"))
    return Dataset(_marked(images, labels), labels, regions)


def _marked(images: DataFrame, labels: DataFrame) -> DataFrame:
    marks = labels.select("export_no", "stem").distinct().withColumn("positive", F.lit(True))
    return images.join(marks, ["export_no", "stem"], "left").withColumn("positive", F.coalesce("positive", F.lit(False)))


def static_dataset(docs: DataFrame, n_val: Sequence[int] = (3,), n_test: Sequence[int] = (3,), seed: int = 42, method: str = "hash") -> Dataset:
    """Static exports, split by setup within each export; method exact deals setups as a sequential generator does."""
    check_exports(docs)
    key = strings.setup_key(F.col("stem"))
    setups = coco.images(docs).select("export_no", strings.setup_key(strings.stem(F.col("file_name"))).alias("key")).distinct()
    n = docs.count()
    val, test = splits.per_export(list(n_val), n), splits.per_export(list(n_test), n)
    if method == "exact":
        groups = splits.keys_by_group(setups, "export_no", "key")
        split_of = splits.assignment(setups, splits.exact_fixed(groups, val, test, seed), "export_no", "key")
    else:
        of = lambda values: F.array(*[F.lit(v) for v in values])[F.col("export_no")]
        split_of = splits.fixed_split(setups, "export_no", "key", of(val), of(test), seed)
    return dataset(docs, split_of.select("key", "split"), key, strings.static_group(key))


def video_dataset(docs: DataFrame, folder: str, val: float = 0.15, test: float = 0.15, seed: int = 42, method: str = "hash") -> Dataset:
    """One video's export, its frames split by ratio."""
    names = coco.images(docs).select(F.lit(folder).alias("folder"), "file_name")
    if method == "exact":
        split_of = splits.assignment(names, splits.exact_ratio(splits.keys_by_group(names, "folder", "file_name"), val, test, seed), "folder", "file_name")
    else:
        split_of = splits.ratio_split(names, "folder", "file_name", ("val", val), ("test", test), "train", seed)
    return dataset(docs, split_of.select(F.col("file_name").alias("key"), "split"), F.col("file_name"), strings.video_group(F.lit(folder)), default=None)


def united(parts: Sequence[Dataset]) -> Dataset:
    """Several datasets as one, told apart by part."""
    out = None
    for i, p in enumerate(parts):
        own = Dataset(*(t.withColumn("part", F.lit(i)) for t in p))
        out = own if out is None else Dataset(*(a.unionByName(b) for a, b in zip(out, own, strict=True)))
    return out


def index_of(data: Dataset) -> tuple[DataFrame, DataFrame]:
    """(stem, source) of all images, and (source, stems) of those with labels."""
    stems, _ = layout.source_index(data.images, "stem", "source", F.col("part"))
    _, groups = layout.source_index(data.images.filter("positive"), "stem", "source", F.col("part"))
    return stems, groups


def merged_coco(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Images, annotations and categories of all exports under dense ids, in export and input order, categories by the first export's names."""
    images, anns, cats = coco.images(docs), coco.annotations(docs), coco.categories(docs)
    first = cats.filter("export_no = 0").drop("export_no", "pos")
    ids = A.canonical_categories(cats, "export_no", "id", "name")
    numbered = A.dense(images, ["pos"])
    rows = anns.join(ids.withColumnRenamed("id", "category_id"), ["export_no", "category_id"])
    rows = rows.join(numbered.select("export_no", F.col("id").alias("image_id"), F.col("new_id").alias("new_image_id")), ["export_no", "image_id"])
    return numbered, A.dense(rows, ["pos"]), first


class Clean(NamedTuple):
    images: DataFrame
    annotations: DataFrame
    missing: DataFrame


def filter_and_canonicalize(docs: DataFrame, keep: Sequence[str] = CLASSES, drop: Sequence[str] = ("ignore object",)) -> Clean:
    """Images with a kept label and no dropped one, and their kept annotations, renumbered; and the labels that don't occur. docs holds one export."""
    A.require(docs.filter("export_no <> 0").select("export_no"), "one export at a time is filtered; there are further ones")
    images, anns, cats = coco.images(docs), coco.annotations(docs), coco.categories(docs)
    rows = join_small(anns, cats.select("export_no", F.col("id").alias("category_id"), F.col("name").alias("label")), ["export_no", "category_id"], "inner")
    kept = A.images_to_keep(rows, "image_id", "label", keep, drop)
    numbered = A.renumber(A.keep_images(images, "id", kept.withColumnRenamed("image_id", "id")), ["pos"], "new_image_id")
    clean = A.keep_annotations(rows, "image_id", "label", kept, keep).withColumn("new_category_id", A.category_ids(keep)[F.col("label")])
    clean = clean.join(numbered.select(F.col("id").alias("image_id"), "new_image_id"), "image_id")
    return Clean(numbered, A.renumber(clean, ["pos"], "new_annotation_id"), A.missing_labels(cats.withColumnRenamed("name", "label"), "label", [*keep, *drop]))


def evaluation_labels(clean: Clean) -> DataFrame:
    """(stem, ann_pos, class_id, poly): the largest polygon of each annotation, or of its masks, clipped in single precision; class ids keep their gaps."""
    size = clean.images.select("new_image_id", strings.stem(F.col("file_name")).alias("stem"), "width", "height")
    poly = F.coalesce(polygons.largest_polygon(F.col("polygons")), rle_polygon(F.col("rles")))
    rows = clean.annotations.withColumn("poly", poly).filter("poly is not null").join(size, "new_image_id")
    return rows.select("stem", F.col("pos").alias("ann_pos"), (F.col("new_category_id") - 1).alias("class_id"), polygons.normalized(F.col("poly"), F.col("width"), F.col("height"), clip=True).alias("poly"))


def mask_bank(clips: DataFrame, masks: DataFrame, reviews: DataFrame, done: DataFrame, least_width: int = 1280, least_height: int = 720, least_share: float = 0.001) -> tuple[DataFrame, DataFrame]:
    """Masks of accepted clips that are large enough, with component and take, and a summary by component.

    clips: video, width, height; masks: video, frame_no, inside, whole; reviews: video, verdict, attempts; done: video.
    """
    work = layout.to_do(stats.resolution_gate(clips, "width", "height", least_width, least_height), done, ["video"])
    accepted = work.join(reviews.filter("verdict = 'accept'"), "video")
    kept = stats.coverage_gate(masks.join(accepted, "video"), F.col("inside").cast("double"), F.col("whole"), least_share)
    s = strings.stem(F.col("video"))
    rows = kept.withColumns({"component": strings.component_id(s), "take": strings.take_number(s)})
    per_clip = rows.groupBy("component", "video").agg(F.count("*").alias("n"))
    return rows, stats.component_summary(per_clip, "component", F.col("n"))
