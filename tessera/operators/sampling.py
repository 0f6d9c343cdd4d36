"""Sampling frames from recordings: ranges of time, every n-th, and a fixed grid with catch-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.operators.ranking import range_bucket, ranked


def _with_span(frames: DataFrame, recording: str, time: str) -> DataFrame:
    """frames with __first and __last, the bounds of their recording: partial minima and maxima are joined, no recording is gathered."""
    spans = durations(frames, recording, time).select(F.col(recording).alias("__r"), F.col("first_time").alias("__first"), F.col("last_time").alias("__last"))
    return frames.join(spans, F.col(recording).eqNullSafe(F.col("__r"))).drop("__r")


def with_offset(frames: DataFrame, recording: str, time: str, name: str = "offset") -> DataFrame:
    """frames with the time since the recording's first frame."""
    return _with_span(frames, recording, time).withColumn(name, F.col(time) - F.col("__first")).drop("__first", "__last")


def trim(frames: DataFrame, recording: str, time: str, start_skip: int = 0, skip_end: int = 0) -> DataFrame:
    """Frames from start_skip after the first to skip_end before the last, that end left out."""
    at = F.col(time) - F.col("__first")
    end = F.greatest(F.lit(0), F.col("__last") - F.col("__first") - F.lit(skip_end))
    return _with_span(frames, recording, time).filter((at >= start_skip) & (at < end)).drop("__first", "__last")


def durations(frames: DataFrame, recording: str, time: str) -> DataFrame:
    """First and last time of each recording and the time between."""
    return frames.groupBy(recording).agg(F.min(time).alias("first_time"), F.max(time).alias("last_time")).withColumn("duration", F.col("last_time") - F.col("first_time"))


def _placed(frames: DataFrame, recording: str, time: str, tie: str, bucket: Column | None) -> DataFrame:
    """frames with __i, their place (from 1) in their recording, and __range, the range of times in which they were sorted; without ranges 0."""
    if bucket is None:
        return ranked(frames, [time, tie], None, "__i", (recording,)).withColumn("__range", F.lit(0))
    return ranked(frames.withColumn("__range", bucket), [time, tie], F.col("__range"), "__i", (recording,))


def _number(frames: DataFrame, time: str) -> Column:
    """A number that grows with the time, for ranges. Dates and times without a zone have no cast to one; their fields give seconds, whatever the session's zone."""
    at = F.col(time)
    if not isinstance(frames.schema[time].dataType, T.DateType | T.TimestampNTZType):
        return at.cast("double")
    at = at.cast("timestamp_ntz")
    return (F.unix_date(at.cast("date")) * F.lit(86_400.0) + F.hour(at) * 3600 + F.minute(at) * 60 + F.date_part(F.lit("SECOND"), at)).cast("double")


def every_nth(frames: DataFrame, recording: str, time: str, tie: str, n: int, name: str = "frame_no") -> DataFrame:
    """Every n-th frame from the first, numbered densely from 0; a recording is sorted in ranges of time, not in one task."""
    at = F.col("__i") - 1
    bucket = range_bucket(frames, _number(frames, time))
    return _placed(frames, recording, time, tie, bucket).filter(F.pmod(at, F.lit(n)) == 0).withColumn(name, F.floor(at / n).cast("int")).drop("__i", "__range")


def stride_sample(frames: DataFrame, recording: str, time: str, tie: str, stride: int, origin: Column | None = None, name: str = "sample_no") -> DataFrame:
    """Frames on a fixed grid of times with catch-up, numbered from 0 within each recording.

    A frame is kept when its time has reached the next target; then the target moves on by one stride, so after a gap
    frames are kept one after the other until the target has caught up. With b the number of the stride that frame i
    (from 1) lies in, c(i) = i + min(0, min over j <= i of b(j) + 1 - j) frames are kept up to i, and i is one of them if
    c grows there. `time` and stride have the same units; the first target is origin, or else the first frame.

    Places and minima are taken within ranges of time and carried over from the ranges before, so no recording is sorted in one task.
    """
    bucket = range_bucket(frames, F.col(time).cast("double"))
    if bucket is None:
        origin = F.min(time).over(Window.partitionBy(recording)) if origin is None else origin
        b = F.floor((F.col(time) - origin) / F.lit(stride))
        rows = _placed(frames, recording, time, tie, None).withColumns({"__b": b + 1 - F.col("__i"), "__before": F.lit(0).cast("long")})
        return _kept(rows, Window.partitionBy(recording).orderBy(time, tie), name).select(*frames.columns, name)
    rows = _with_span(frames, recording, time) if origin is None else frames
    b = F.floor((F.col(time) - (F.col("__first") if origin is None else origin)) / F.lit(stride))
    rows = _placed(rows, recording, time, tie, bucket).withColumn("__b", b + 1 - F.col("__i"))
    part = rows.groupBy(F.col(recording).alias("__r"), F.col("__range").alias("__k")).agg(F.min("__b").alias("__m"))
    earlier = Window.partitionBy("__r").orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select("__r", "__k", F.least(F.lit(0), F.min("__m").over(earlier)).alias("__before"))
    rows = rows.join(part, F.col(recording).eqNullSafe(F.col("__r")) & (F.col("__range") == F.col("__k")))
    return _kept(rows, Window.partitionBy(recording, "__range").orderBy("__i"), name).select(*frames.columns, name)


def _kept(rows: DataFrame, inside: Window, name: str) -> DataFrame:
    """The frames at which c grows, numbered by it; __before is the minimum carried over from earlier ranges."""
    low = lambda last: F.least(F.col("__before"), F.min("__b").over(inside.rowsBetween(Window.unboundedPreceding, last)))
    rows = rows.withColumns({"__c": F.col("__i") + low(0), "__p": F.col("__i") - 1 + low(-1)})
    return rows.filter(F.col("__c") > F.col("__p")).withColumn(name, (F.col("__c") - 1).cast("int"))


def manifest(kept: DataFrame, recording: str, seconds: Column, name: Column, sample_no: str = "sample_no") -> DataFrame:
    """(source, filename, time_sec, idx) of kept frames, times rounded to four decimals."""
    return kept.select(F.col(recording).alias("source"), name.alias("filename"), F.bround(seconds, 4).alias("time_sec"), F.col(sample_no).alias("idx"))


def recording_stats(manifest: DataFrame, durations: DataFrame, recording: str, fmt: str) -> DataFrame:
    """One row for each recording: format, duration in seconds, number of frames and their manifest in order."""
    frames = manifest.groupBy("source").agg(F.count("*").alias("n_frames_saved"), F.sort_array(F.collect_list(F.struct("idx", "filename", "time_sec"))).alias("manifest"))
    return durations.select(F.col(recording).alias("source"), (F.col("duration") / 1e9).alias("total_duration_sec")).join(frames, "source", "left").select("source", F.lit(fmt).alias("format"), "total_duration_sec", F.coalesce("n_frames_saved", F.lit(0)).alias("n_frames_saved"), "manifest")


def topic_choice(topics: DataFrame, by: list[str], topic_id: str, topic_name: str, topic_type: Column | None = None) -> DataFrame:
    """The colour topic of each recording: an exact name first, then one that says color and image, then any image; the smallest id within a rank."""
    image = F.lit(True) if topic_type is None else topic_type.contains("Image")
    low = F.lower(topic_name)
    rank = F.when(image & F.col(topic_name).contains("Color_0/image/data"), 0).when(image & low.contains("color") & low.contains("image"), 1).when(image, 2)
    return pick_first(topics.withColumn("__rank", rank).filter(F.col("__rank").isNotNull()), by, ["__rank", topic_id]).drop("__rank")


def without_topic(topics: DataFrame, by: list[str], topic_id: str, topic_name: str, topic_type: Column | None = None) -> DataFrame:
    """Recordings none of whose topics has images."""
    return topics.select(*by).distinct().join(topic_choice(topics, by, topic_id, topic_name, topic_type).select(*by), by, "left_anti")


def random_n(rows: DataFrame, by: list[str], key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows of each group without replacement, in the order of a hash of seed and key; the rest is dropped before any group is gathered whole."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key))
    return rows.withColumn("__r", place).filter(F.col("__r") <= n).drop("__r")


def pick_first(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each group; partial minima move, not the groups."""
    rest = [c for c in df.columns if c not in by]
    first = F.min_by(F.struct(*rest), F.struct(*order)) if by else None
    return df.groupBy(*by).agg(first.alias("__f")).select(*by, *[F.col("__f")[c].alias(c) for c in rest])
