"""Statistics over labels, pixels and clips, as partial and final aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numbers import EPSILON, transfer
from tessera.operators.ranking import range_bucket, ranked
from tessera.tables import stored


def size_calibration(labels: DataFrame, group: str, area: Column) -> DataFrame:
    """Number, median, 5th and 95th percentile of the positive areas of each class; percentiles interpolate and are cut to whole numbers.

    Equal areas are counted before they move, and the counts, stored, summed up in ranges, so no class is gathered in one task.
    """
    counts = stored(labels.withColumn("__a", area).filter("__a > 0").groupBy(group, "__a").agg(F.count("*").alias("__w")), "areas")
    upto = ranked(counts, [F.col("__a")], range_bucket(counts, F.col("__a").cast("double")), "__upto", (group,), "n_samples", F.col("__w"))
    a, n = F.col("__a").cast("double"), F.col("n_samples")
    aggs, out = [], []
    for name, p in (("median_area", 0.5), ("p05_area", 0.05), ("p95_area", 0.95)):
        place = F.lit(p) * (n - 1)
        low = F.floor(place)
        aggs += [F.min(F.when(F.col("__upto") > low, a)).alias(f"{name}_low"), F.min(F.when(F.col("__upto") > F.least(low + 1, n - 1), a)).alias(f"{name}_high"), F.first(place - low).alias(f"{name}_part")]
        out.append((F.col(f"{name}_low") + (F.col(f"{name}_high") - F.col(f"{name}_low")) * F.col(f"{name}_part")).cast("int").alias(name))
    return upto.groupBy(group).agg(F.first("n_samples").alias("n_samples"), *aggs).select(group, "n_samples", *out)


def image_partials(pixels: DataFrame, image: str, group: str, value: Column) -> DataFrame:
    """Count, sum and sum of squares of each image: what pools are built from, however many pixels."""
    v = value.cast("double")
    return pixels.groupBy(group, image).agg(F.count(v).alias("n"), F.sum(v).alias("s"), F.sum(v * v).alias("ss"), F.stddev_pop(v).alias("sd"))


def pool(partials: DataFrame, group: str, noise: Column | None = None) -> DataFrame:
    """Of each group: mean and population deviation over all pixels, the plain mean of the images' noise, pixels and images.

    The deviation is summed around each image's own mean first, which loses no digits to large means.
    """
    noise = F.col("sd") if noise is None else noise
    parts = partials.withColumns({"m": F.col("s") / F.col("n"), "inner": F.col("n") * F.col("sd") * F.col("sd"), "noise": noise})
    sums = parts.groupBy(group).agg(F.sum("n").alias("n_pixels"), F.sum("s").alias("s"), F.sum("inner").alias("inner"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("mm"), F.avg("noise").alias("noise"), F.count("*").alias("n_images"))
    mean = F.col("s") / F.col("n_pixels")
    spread = (F.col("inner") + F.col("mm")) / F.col("n_pixels") - mean * mean
    return sums.select(group, mean.alias("mean"), (F.sqrt(F.greatest(F.lit(0.0), spread)) + EPSILON).alias("std"), "noise", "n_pixels", "n_images")


def lab_pool(partials: DataFrame, group: str, partial: str = "p", channels: int = 3) -> DataFrame:
    """Pools of three-channel partials (n, s, inner, noise) of images: lab_mean, lab_std, lap_noise, n_pixels, n_stems.

    n_stems counts the images listed, those without a partial too; a group without any has null statistics.
    """
    p = F.col(partial)
    aggs = [F.sum(p["n"]).alias("n"), F.avg(p["noise"]).alias("lap_noise"), F.count("*").alias("n_stems")]
    for c in range(channels):
        s, inner = p["s"][c], p["inner"][c]
        aggs += [F.sum(s).alias(f"s{c}"), F.sum(inner).alias(f"i{c}"), F.sum(s * s / p["n"]).alias(f"m{c}")]
    sums = partials.groupBy(group).agg(*aggs)
    mean = [F.col(f"s{c}") / F.col("n") for c in range(channels)]
    std = [F.sqrt(F.greatest(F.lit(0.0), (F.col(f"i{c}") + F.col(f"m{c}")) / F.col("n") - mean[c] * mean[c])) + EPSILON for c in range(channels)]
    return sums.select(group, F.array(*mean).alias("lab_mean"), F.array(*std).alias("lab_std"), "lap_noise", F.coalesce("n", F.lit(0)).alias("n_pixels"), "n_stems")


def moved(rows: DataFrame, group: str, value: str, source: str, target: str, name: str = "moved") -> DataFrame:
    """The source group's values with the target group's mean and deviation."""
    stats = rows.filter(F.col(group).isin(source, target)).groupBy(group).agg(F.avg(value).alias("m"), (F.stddev_pop(value) + EPSILON).alias("s"))
    of = lambda which, column: stats.filter(F.col(group) == which).select(column).scalar()
    out = transfer(F.col(value), of(source, "m"), of(source, "s"), of(target, "m"), of(target, "s"))
    return rows.filter(F.col(group) == source).withColumn(name, out)


def with_pool(rows: DataFrame, group_of: DataFrame, pools: DataFrame, key: str, group: str) -> DataFrame:
    """rows with their key's group and its pool, both optional."""
    return rows.join(group_of, key, "left").join(pools, group, "left")


def component_summary(clips: DataFrame, component: str, n_masks: Column) -> DataFrame:
    return clips.groupBy(component).agg(F.count("*").alias("n_videos"), F.sum(n_masks).cast("long").alias("n_masks"))


def augmentation_summary(images: DataFrame, positive: Column, n_tried: Column, n_made: Column) -> DataFrame:
    """Six counters over a run's training images: all, with labels, without any, variants tried, variants written, and images in the end."""
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return images.agg(
        F.count("*").alias("train_images_total"),
        F.count_if(positive).alias("train_images_with_labels"),
        F.count_if(~positive).alias("train_images_hard_negatives"),
        whole(n_tried).alias("augmentation_attempts"),
        whole(n_made).alias("augmented_images_written"),
        (F.count("*") + whole(n_made)).alias("final_train_image_count"),
    )


def resolution_gate(clips: DataFrame, width: str, height: str, least_width: int = 1280, least_height: int = 720) -> DataFrame:
    """Clips with both sides known and large enough."""
    return clips.filter((F.col(width) > 0) & (F.col(height) > 0) & (F.col(width) >= least_width) & (F.col(height) >= least_height))


def coverage_gate(masks: DataFrame, inside: Column, whole: Column, least: float = 0.001) -> DataFrame:
    """Masks that cover at least a share of their image."""
    return masks.filter(~(inside / whole < F.lit(float(least))))


def tight_box(pixels: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """The box of each mask's set pixels, with their number."""
    return pixels.groupBy(*by).agg(F.min(x).alias("x0"), F.min(y).alias("y0"), F.max(x).alias("x1"), F.max(y).alias("y1"), F.count("*").alias("area"))
