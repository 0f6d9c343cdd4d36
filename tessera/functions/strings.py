"""Names of files, setups, components and frames, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of images and recordings (fixed values).
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg")
VIDEO_SUFFIXES = (".mp4", ".mov", ".avi", ".mkv", ".bag")


def base_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(path, "/", -1)


def parent_name(path: Column) -> Column:
    """The folder that a path's last part lies in, or an empty string."""
    return F.regexp_extract(path, r"([^/]*)/[^/]*$", 1)


def suffix(path: Column) -> Column:
    """The last extension with its dot in lower case, or an empty string; a leading dot starts no extension."""
    return F.lower(F.regexp_extract(base_name(path), r"^.+(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    """The last part of a path without its last extension."""
    return F.regexp_replace(base_name(path), r"^(.+)\.[^.]+$", "$1")


def has_suffix(path: Column, suffixes: Iterable[str] = IMAGE_SUFFIXES) -> Column:
    return suffix(path).isin(*[s.lower() for s in suffixes])


def setup_key(stem: Column) -> Column:
    """Digits before the first underscore, or else the whole stem."""
    return F.coalesce(F.nullif(F.regexp_extract(stem, r"^([0-9]+)_", 1), F.lit("")), stem)


def component_id(stem: Column) -> Column:
    """The stem without its last part, if that is a number after an underscore; else the whole stem."""
    return F.when(stem.rlike(r"^.*_[0-9]+$"), F.regexp_extract(stem, r"^(.*)_([0-9]+)$", 1)).otherwise(stem)


def take_number(stem: Column, default: str = "00") -> Column:
    """The number that component_id leaves out."""
    return F.when(stem.rlike(r"^.*_[0-9]+$"), F.regexp_extract(stem, r"^(.*)_([0-9]+)$", 2)).otherwise(F.lit(default))


def component_class(component: Column) -> Column:
    """What comes before the first underscore."""
    return F.split_part(component, F.lit("_"), F.lit(1))


def static_group(setup: Column) -> Column:
    return F.concat(F.lit("static_setup_"), setup)


def video_group(folder: Column) -> Column:
    return F.concat(F.lit("video_"), folder)


def frame_name(stem: Column, index: Column, hundredths: Column) -> Column:
    """`<stem>_<index, four digits>_t<seconds, two decimals>s.png`, from whole hundredths of a second."""
    number = F.when(index < 10_000, F.lpad(index.cast("string"), 4, "0")).otherwise(index.cast("string"))
    whole, part = F.floor(hundredths / 100).cast("string"), F.lpad(F.pmod(hundredths, F.lit(100)).cast("string"), 2, "0")
    return F.concat(stem, F.lit("_"), number, F.lit("_t"), whole, F.lit("."), part, F.lit("s.png"))


_FRAME = r"^(.*)_([0-9]{4,})_t([0-9]+\.[0-9]{2})s\.png$"


def frame_stem(name: Column) -> Column:
    return F.regexp_extract(name, _FRAME, 1)


def frame_index(name: Column) -> Column:
    """Null for a name of another kind."""
    return F.regexp_extract(name, _FRAME, 2).try_cast("int")


def frame_seconds(name: Column) -> Column:
    return F.regexp_extract(name, _FRAME, 3).try_cast("double")


def rgb_of_mask(path: Column) -> Column:
    """The image that a mask file goes with."""
    return F.regexp_replace(path, r"_mask\.png$", ".png")
