"""File inventories and the plan that moves a flat folder into the sharded store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.store import (
    base_name,
    extension_of,
    is_image_file,
    is_numeric_stem,
    prefix1,
    prefix2,
    resize_gate,
    stem_of,
    store_path,
)
from .skew import heavy_keys, spread_join


def store_places(ids: DataFrame, base: str = "store") -> DataFrame:
    """Prefixes and path of each ``gbif_id``."""
    stem = F.col("gbif_id").cast("string")
    return ids.select(
        "gbif_id",
        prefix1(stem).alias("prefix1"),
        prefix2(stem).alias("prefix2"),
        store_path(base, stem).alias("store_path"),
    )


def under(inventory: DataFrame, folder: str, recursive: bool = True) -> DataFrame:
    """Files below ``folder``, or only those directly in it."""
    below = inventory.filter(F.col("path").startswith(folder + "/"))
    if recursive:
        return below
    rest = F.substr(F.col("path"), F.lit(len(folder) + 2))
    return below.filter(~rest.contains("/"))


def count_files(inventory: DataFrame, folder: str, recursive: bool = True) -> DataFrame:
    return under(inventory, folder, recursive).agg(
        F.lit(folder).alias("folder"),
        F.count("*").alias("n_files"),
        (F.coalesce(F.sum("length"), F.lit(0)).cast("double") / F.lit(1048576.0).cast("double")).alias("mb"),
    )


def image_files(inventory: DataFrame) -> DataFrame:
    """Files with an image extension in all-lower or all-upper case."""
    return inventory.filter(is_image_file(F.col("path")))


def by_extension(inventory: DataFrame) -> DataFrame:
    files = image_files(inventory)
    return files.groupBy(extension_of(F.col("path")).alias("ext")).agg(F.count("*").alias("n_files"))


def reorganise_plan(inventory: DataFrame, base: str = "store") -> DataFrame:
    """``path, target, action, collision`` for each image file of a flat folder.

    Files whose stem is not a number are skipped. A target wanted by several files is a collision.
    Targets are counted before they are joined back, only those wanted twice take part, and a
    much-wanted target is spread, so neither skipped files nor copies gather in one task.
    """
    stem = stem_of(F.col("path"))
    target = F.when(is_numeric_stem(stem), store_path(base, stem, base_name(F.col("path"))))
    files = image_files(inventory).select("path", target.alias("target"))
    contested = (
        files.filter(F.col("target").isNotNull())
        .groupBy("target")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1)
        .select("target", F.lit(True).alias("contested"))
    )
    moving = files.filter(F.col("target").isNotNull())
    moved = spread_join(moving, contested, heavy_keys(moving, "target")["target"], by=F.col("path"), how="left")
    skipped = files.filter(F.col("target").isNull()).withColumn("contested", F.lit(False))
    return moved.unionByName(skipped).select(
        "path",
        "target",
        F.when(F.col("target").isNull(), "skip").otherwise("move").alias("action"),
        F.coalesce("contested", F.lit(False)).alias("collision"),
    )


def action_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count("*").alias("n_files"))


def gate_counts(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy(resize_gate(F.col("length")).alias("gate")).agg(F.count("*").alias("n_files"))
