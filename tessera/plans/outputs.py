"""Runs that end in files: datasets with labels, regions and images, augmented datasets with their logs, frames and mask banks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import layout, stats
from tessera.plans import runs
from tessera.raster import augment
from tessera.sinks import files, labels
from tessera.sources import png
from tessera.tables import stored


def write_dataset(data: runs.Dataset, root: str, sources: DataFrame | None = None, mode: str = "overwrite", names: Sequence[str] = runs.CLASSES) -> DataFrame:
    """Labels, regions, the description and, where their paths are given, images of a dataset; (kind, n_written, n_missing).

    sources has (file_name, path) of the images found. A missing image is counted and skipped.
    """
    files.prepare(root, mode)
    texts = labels.label_texts(data.images, data.labels, "stem", "ann_pos", "class_id", "poly")
    done = [labels.write_labels(texts, root, "split", "stem").withColumn("kind", F.lit("labels"))]
    region = augment.region_png(F.col("polygons"), F.col("width"), F.col("height"))
    done.append(files.write_files(data.regions, root, F.concat(F.lit("paste_regions/"), "stem", F.lit(".png")), region, "overwrite").withColumn("kind", F.lit("regions")))
    if sources is not None:
        found = data.images.join(sources, "file_name", "left")
        done.append(files.copy_files(found, root, F.col("path"), F.concat(F.lit("images/"), "split", F.lit("/"), F.element_at(F.split("file_name", "/"), -1))).withColumn("kind", F.lit("images")))
    files.write_bytes(f"{root}/dataset.yaml", labels.dataset_yaml(names).encode())
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return stored(out.groupBy("kind").agg(F.count_if("written").alias("n_written"), F.count_if(~F.col("written")).alias("n_missing")), "written")


def calibration(train: DataFrame) -> DataFrame:
    """Sizes by class of training labels (class_id, poly, width, height), by rasterised pixels."""
    return stats.size_calibration(train, "class_id", augment.raster_area(F.col("poly"), F.col("width"), F.col("height")))


def pools(images: DataFrame, index: DataFrame) -> DataFrame:
    """Pools by source of (stem, png, labels), for the stems listed in the index (stem, source)."""
    polys = F.transform("labels", lambda x: x["poly"])
    return stats.lab_pool(index.join(images, "stem", "left").select("source", augment.component_partials(F.col("png"), polys).alias("p")), "source")


def augmented(images: DataFrame, bank: augment.Bank, variants: int, settings: augment.Settings = augment.Settings(), index: DataFrame | None = None, regions: DataFrame | None = None, negatives: bool = True) -> DataFrame:
    """Variants of training images (stem, png, labels); with an index, images without labels get their source's pool.

    regions has (stem, region). Without `negatives`, images without labels have no variants.
    """
    rows = images if negatives else images.filter(F.size("labels") > 0)
    rows = rows.join(regions, "stem", "left") if regions is not None else rows.withColumn("region", F.lit(None).cast("binary"))
    if index is None:
        rows = rows.withColumn("pool", F.lit(None).cast("string"))
    else:
        pool = stored(pools(images, index), "pools").filter("n_pixels > 0")
        both = stats.with_pool(rows, index.select("stem", "source"), pool, "stem", "source")
        rows = both.withColumn("pool", F.when(F.col("lab_mean").isNotNull(), F.concat_ws("", F.lit("["), F.to_json("lab_mean"), F.lit(","), F.to_json("lab_std"), F.lit(","), F.col("lap_noise").cast("string"), F.lit("]"))))
    return augment.augment_table(rows.select("stem", "png", "labels", "region", "pool"), bank, variants, settings)


def write_augmented(
    made: DataFrame,
    images: DataFrame,
    root: str,
    settings: augment.Settings,
    variants: int,
    negatives: bool = True,
    mode: str = "error",
    sizes: DataFrame | None = None,
    copies: DataFrame | None = None,
    names: Sequence[str] | dict[int, str] = runs.CLASSES,
    where: dict[str, str] | None = None,
) -> DataFrame:
    """A dataset of training images (stem, png, labels) and their variants, with labels, description and log; the summary's counters.

    Originals keep their bytes, and get an empty label file without labels. Variant k of an image is <stem>_aug<k>. copies has
    (source, path) of files that go along unchanged, such as those of other splits. where names the run's folders in the log.
    """
    files.prepare(root, mode)
    made = stored(made, "augmented").withColumn("name", F.concat("stem", F.lit("_aug"), F.col("aug").cast("string")))
    path = lambda kind, name, end: F.concat(F.lit(f"{kind}/train/"), name, F.lit(end))
    every = made.select("name", "png", "labels").unionByName(images.select(F.col("stem").alias("name"), "png", "labels"))
    rows = every.select("name", F.posexplode("labels").alias("no", "l")).select("name", "no", "l.*")
    texts = labels.label_texts(every.select("name", F.lit("train").alias("split")), rows, "name", "no", "class_id", "poly")
    written = files.write_files(every, root, path("images", "name", ".png"), F.col("png"), "overwrite").unionByName(labels.write_labels(texts, root, "split", "name"))
    if copies is not None:
        written = written.unionByName(files.copy_files(copies, root, F.col("source"), F.col("path")))
    stored(written, "written")
    files.write_bytes(f"{root}/dataset.yaml", labels.dataset_yaml(names).encode())
    per = images.select("stem", (F.size("labels") > 0).alias("positive")).join(made.groupBy("stem").agg(F.count("*").alias("n")), "stem", "left").fillna(0, ["n"])
    tried = F.when(F.col("positive") | F.lit(negatives), variants).otherwise(0)
    summary = stored(stats.augmentation_summary(per, F.col("positive"), tried, F.col("n")), "augmented-summary")
    entries = made.select(path("images", "name", ".png").alias("augmented_image"), path("labels", "name", ".txt").alias("augmented_label"), path("images", "stem", ".png").alias("source_image"), "n_pasted", "pastes")
    args = asdict(settings) | {"augs_per_image": variants, "augment_negatives": negatives}
    log = labels.augmentation_log(entries, summary, args, (where or {}) | {"out_dataset": root}, sizes)
    stored(files.write_files(log, root, F.lit("augmentation_log.json"), F.col("value"), "overwrite"), "written")
    return summary


@F.arrow_udf(T.BinaryType())
def frame_png(image: pa.Array) -> pa.Array:
    """The PNG of a decoded frame (height, width, data in BGR); null for none."""
    pixels = lambda v: np.frombuffer(v["data"], np.uint8).reshape(v["height"], v["width"], 3)
    return pa.array([png.encode(pixels(v)) if (v := x.as_py()) else None for x in image], pa.binary())


def write_frames(frames: DataFrame, root: str, mode: str = "overwrite") -> DataFrame:
    """(path, written) of sampled frames (file_name, image) written as PNG files; frames that can't be decoded were left out before sampling, so they take no number."""
    return files.write_files(frames, root, F.col("file_name"), frame_png(F.col("image")), mode)


def write_mask_bank(rows: DataFrame, clips: DataFrame, root: str, mode: str = "error", where: dict[str, str] | None = None, args: dict[str, object] | None = None) -> DataFrame:
    """(path, written) of a mask bank: frame and mask of each kept row, and the manifest of its clips.

    rows has (output_dir, frame_no, image, mask), both PNGs; clips has the columns of the manifest but n_masks_saved, which is
    counted here; clips without a mask are left out.
    """
    files.prepare(root, mode)
    at = F.concat("output_dir", F.lit("/frame_"), F.lpad(F.col("frame_no").cast("string"), 6, "0"))
    at = F.when(F.col("frame_no") < 1_000_000, at).otherwise(F.concat("output_dir", F.lit("/frame_"), F.col("frame_no").cast("string")))
    pair = F.explode(F.array(F.struct(F.lit(".png").alias("end"), F.col("image").alias("data")), F.struct(F.lit("_mask.png").alias("end"), F.col("mask").alias("data"))))
    both = rows.select(at.alias("at"), pair.alias("f"))
    written = stored(files.write_files(both, root, F.concat("at", "f.end"), F.col("f.data"), "overwrite"), "written")
    counted = clips.join(rows.groupBy("output_dir").agg(F.count("*").alias("n_masks_saved")), "output_dir")
    document = labels.mask_manifest(counted, (where or {}) | {"out_dir": root}, args or {})
    return written.unionByName(stored(files.write_files(document, root, F.lit("manifest.json"), F.col("value"), "overwrite"), "written"))


def sources_of(wanted: DataFrame, listing: DataFrame, order: Sequence[str] = layout.EXPORT_ORDER) -> DataFrame:
    """(file_name, path): where each image lies among the listed paths of an export."""
    return layout.locate(wanted.select("file_name").distinct(), "file_name", listing, "path", order, "path")
