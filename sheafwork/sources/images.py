"""Decoded images and the files that are none."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_images(spark: SparkSession, path: str | list[str], drop_invalid: bool = False) -> DataFrame:
    """Image structs, one row per file; a file that cannot be decoded has height -1."""
    reader = spark.read.format("image").option("dropInvalid", drop_invalid).option("recursiveFileLookup", True)
    return reader.load(path).select("image.*")


def read_large_images(spark: SparkSession, folder: str, wanted: Callable[[F.Column], F.Column]) -> DataFrame:
    """Images directly in a folder whose file size is ``wanted``; the others are dropped in the scan's stage."""
    files = spark.read.format("image").option("dropInvalid", False).load(folder)
    return files.filter(wanted(F.col("_metadata.file_size"))).select("image.*")


def plain_path(origin) -> F.Column:
    """Origin as a path: without scheme, with escapes undone."""
    return F.regexp_replace(F.url_decode(F.replace(origin, F.lit("+"), F.lit("%2B"))), r"^file:/+", "/")


def scan_report(listing: DataFrame, images: DataFrame) -> DataFrame:
    """``path, length, height, width, readable`` for every listed file.

    Files the image source passes over (empty ones) are reported as unreadable too.
    """
    decoded = images.select(plain_path(F.col("origin")).alias("path"), "height", "width")
    plain = F.regexp_replace("path", r"^file:/+", "/")
    joined = listing.withColumn("path", plain).join(decoded, "path", "left")
    readable = F.coalesce(F.col("height") >= 0, F.lit(False))
    return joined.select("path", "length", "height", "width", readable.alias("readable"))
