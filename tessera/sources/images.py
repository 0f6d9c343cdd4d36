"""Images of all formats that the JVM decodes (PNG, JPEG, GIF, BMP), as the rows that the rasters take."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.strings import stem
from tessera.sources import png


@F.arrow_udf(T.BinaryType())
def as_png(image: pa.Array) -> pa.Array:
    """The PNG of a decoded image (origin, height, width, nChannels, data by rows in BGR order); alpha is left out, null stays null, and one without sides is an error."""
    out = []
    for x in image:
        v = x.as_py()
        if v is None:
            out.append(None)
            continue
        if v["height"] <= 0:
            raise ValueError(f"{v['origin']} can't be decoded")
        pixels = np.frombuffer(v["data"], np.uint8).reshape(v["height"], v["width"], v["nChannels"])
        out.append(png.encode(pixels[:, :, 0] if v["nChannels"] == 1 else pixels[:, :, :3]))
    return pa.array(out, pa.binary())


def read_images(spark: SparkSession, path: str, unreadable: str = "fail") -> DataFrame:
    """(path, stem, width, height, png) of the images below a path, decoded by Spark's image source.

    Files that can't be decoded are an error, or left out with unreadable="drop"; unreadable_images lists them.
    """
    if unreadable not in ("fail", "drop"):
        raise ValueError("unreadable must be fail or drop")
    rows = spark.read.format("image").option("dropInvalid", str(unreadable == "drop").lower()).option("recursiveFileLookup", "true").load(path)
    return rows.select(F.col("image.origin").alias("path"), stem(F.col("image.origin")).alias("stem"), "image.width", "image.height", as_png("image").alias("png"))


def unreadable_images(spark: SparkSession, path: str) -> DataFrame:
    """Paths of the files below a path that can't be decoded."""
    rows = spark.read.format("image").option("recursiveFileLookup", "true").load(path)
    return rows.filter("image.width <= 0").select(F.col("image.origin").alias("path"))
