"""Label files, split manifests, source indexes and dataset descriptions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.polygons import n_points, parsed_label
from tessera.functions.strings import stem


def read_labels(spark: SparkSession, path: str, least_points: int = 3) -> DataFrame:
    """(stem, line_no, class_id, poly) of the label files below a path; lines with too few tokens or points are left out."""
    texts = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    lines = texts.select(stem(F.col("_metadata.file_path")).alias("stem"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    rows = lines.withColumn("l", parsed_label(F.col("line"))).filter("l is not null").select("stem", "line_no", "l.*")
    return rows.filter(n_points(F.col("poly")) >= least_points)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file_name) of a manifest's lines, trimmed, blank ones left out."""
    return spark.read.text(path).select(F.trim("value").alias("file_name")).filter("file_name <> ''")


def read_source_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(stem, source) and (source, stems) of a source index; maps that are missing count as empty."""
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", "stem_to_source map<string, string>, source_to_component_stems map<string, array<string>>").alias("d"))
    return doc.select(F.explode("d.stem_to_source").alias("stem", "source")), doc.select(F.explode("d.source_to_component_stems").alias("source", "stems"))


def parse_dataset_yaml(text: str) -> dict:
    """path, train, val, test and names (id to name) of a dataset's description: the flat subset of YAML that such files use."""
    out: dict = {"names": {}}
    within = False
    for line in text.splitlines():
        line = re.sub(r"(^|\s)#.*$", "", line).rstrip()
        if not line.strip():
            continue
        key, colon, value = line.strip().partition(":")
        value = value.strip()
        if within and (line[0].isspace() or line.startswith("-")):
            if line.strip().startswith("-"):
                out["names"][len(out["names"])] = _plain(line.strip()[1:])
            elif colon:
                out["names"][int(_plain(key))] = _plain(value)
            continue
        within = key == "names"
        if within and value:
            items = [x for x in value.strip("[]{}").split(",") if x.strip()]
            pairs = [x.split(":", 1) for x in items] if value.startswith("{") else enumerate(items)
            out["names"] = {int(_plain(str(k))): _plain(v) for k, v in pairs}
        elif not within and colon:
            out[key] = _plain(value)
    return out


def _plain(text: str) -> str:
    text = text.strip()
    return text[1:-1] if len(text) > 1 and text[0] == text[-1] and text[0] in "'\"" else text
