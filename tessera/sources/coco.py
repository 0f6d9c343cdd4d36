"""COCO exports: one JSON document each, as tables of images, annotations and categories.

A segmentation is a list of polygons, one run-length mask or a list of such masks, their counts a list or a compressed
string. It is read into two columns: `polygons`, and `rles` for the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RLE = "struct<size: array<int>, counts_list: array<int>, counts_str: string>"
IMAGES = "array<struct<id: bigint, width: int, height: int, file_name: string, license: bigint, flickr_url: string, coco_url: string, date_captured: string>>"
ANNOTATIONS = "array<struct<id: bigint, image_id: bigint, category_id: bigint, segmentation: string, area: double, bbox: array<double>, iscrowd: bigint, attributes: struct<occluded: boolean>>>"
CATEGORIES = "array<struct<id: bigint, name: string, supercategory: string>>"
INFO = "struct<contributor: string, date_created: string, description: string, url: string, version: string, year: string>"
LICENSES = "array<struct<id: bigint, name: string, url: string>>"
DOCUMENT = f"images {IMAGES}, annotations {ANNOTATIONS}, categories {CATEGORIES}, info {INFO}, licenses {LICENSES}"


def documents(spark: SparkSession, exports: list[str], pattern: str = "annotations/*.json") -> DataFrame:
    """(export_no, path, doc) of each export: the first file by path; an error where an export has none."""
    out = None
    for i, export in enumerate(exports):
        texts = spark.read.text(f"{export}/{pattern}", wholetext=True).withColumn("path", F.col("_metadata.file_path"))
        first = texts.agg(F.min_by("value", "path").alias("value"), F.min("path").alias("path"))
        text = F.coalesce("value", F.raise_error(F.lit(f"{export} has no {pattern}")).cast("string"))
        one = first.select(F.lit(i).alias("export_no"), "path", F.from_json(text, DOCUMENT).alias("doc"))
        out = one if out is None else out.unionByName(one)
    return out


def first_complete(spark: SparkSession, export: str) -> DataFrame:
    """(export_no, path, doc) of the first file anywhere below that parses and has images, annotations and categories."""
    texts = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(export, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    keys = F.json_object_keys("value")
    whole = texts.filter(F.coalesce(F.array_contains(keys, "images") & F.array_contains(keys, "annotations") & F.array_contains(keys, "categories"), F.lit(False)))
    first = whole.agg(F.min_by("value", "path").alias("value"), F.min("path").alias("path"))
    text = F.coalesce("value", F.raise_error(F.lit(f"{export} has no complete document")).cast("string"))
    return first.select(F.lit(0).alias("export_no"), "path", F.from_json(text, DOCUMENT).alias("doc"))


def _exploded(docs: DataFrame, part: str) -> DataFrame:
    return docs.select("export_no", F.posexplode(f"doc.{part}").alias("pos", "x")).select("export_no", "pos", "x.*")


def images(docs: DataFrame) -> DataFrame:
    return _exploded(docs, "images")


def categories(docs: DataFrame) -> DataFrame:
    return _exploded(docs, "categories")


def annotations(docs: DataFrame) -> DataFrame:
    """Annotations with `polygons` and `rles` for the segmentation; both null if it is neither."""
    rows = _exploded(docs, "annotations")
    return rows.withColumns({"polygons": polygons_of(F.col("segmentation")), "rles": rles_of(F.col("segmentation"))}).drop("segmentation")


def polygons_of(segmentation: Column) -> Column:
    """The polygons of a segmentation's JSON text; null for masks."""
    is_list = segmentation.rlike(r"^\s*\[\s*(\[|\])")
    return F.when(is_list, F.from_json(segmentation, "array<array<double>>"))


def rles_of(segmentation: Column) -> Column:
    """The run-length masks of a segmentation's JSON text; null for polygons."""
    one = "size array<int>, counts string"
    many = F.when(segmentation.rlike(r"^\s*\[\s*\{"), F.from_json(segmentation, f"array<struct<{one.replace(' array', ': array').replace('counts string', 'counts: string')}>>"))
    single = F.when(segmentation.rlike(r"^\s*\{"), F.array(F.from_json(segmentation, one)))
    is_list = lambda c: c.rlike(r"^\s*\[")
    return F.transform(
        F.coalesce(many, single),
        lambda r: F.struct(
            r["size"].alias("size"),
            F.when(is_list(r["counts"]), F.from_json(r["counts"], "array<int>")).alias("counts_list"),
            F.when(~is_list(r["counts"]), r["counts"]).alias("counts_str"),
        ),
    )
