"""Image folder jobs: batch resize, reorganising plan, quality of copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.store import DEFAULT_BOX, resize_gate, stem_of
from ..operators.images import UNREADABLE, resized
from ..operators.layout import action_counts, gate_counts, reorganise_plan
from ..operators.quality import all_paired, with_psnr
from ..sources.images import plain_path, read_images, read_large_images
from ..sources.listing import list_files, list_flat, resolved
from ..staging import staged


def resize_folder(spark: SparkSession, folder: str, target: str, box: int = DEFAULT_BOX) -> DataFrame:
    """Shrink the large images of a flat folder into Parquet at ``target``; gives the gate counts.

    The gate is asked of the file's size, so no image meets a listing, and one that can't be decoded
    comes out with its ``error``. ``changed`` says whether a JPEG copy would differ in size or format. Images ``target``
    already holds are left out, so a job that runs again adds nothing twice. ``resize_outcomes`` accounts for every file.
    """
    place = resolved(folder)
    listing = staged(list_flat(spark, place), "listing")
    large = read_large_images(spark, place, lambda size: resize_gate(size) == "resize")
    try:
        done = spark.read.parquet(target).select("origin").distinct()
        large = large.join(done, "origin", "left_anti")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    sized = large.withColumns({"_width": F.col("width"), "_height": F.col("height")})
    other = (F.col("width") != F.col("_width")) | (F.col("height") != F.col("_height"))
    jpeg = F.lower(F.col("origin")).rlike(r"\.jpe?g$")
    changed = F.when(F.col("error").isNull(), other | ~jpeg)
    resized(sized, box).withColumn("changed", changed).drop("_width", "_height").write.mode("append").parquet(target)
    return gate_counts(listing)


def resize_outcomes(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """``path, length, outcome, width, height`` of every file of the folder, after ``resize_folder`` into ``target``.

    The outcome is ``resized``, ``unchanged``, ``unreadable``, ``failed``, ``missing`` (due, but not in the target), or
    the gate's reason to leave a file out; so their counts add up to the listing.
    """
    listing = list_flat(spark, resolved(folder)).withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    stored = spark.read.parquet(target)
    done = stored.select(plain_path(F.col("origin")).alias("path"), "width", "height", "error", "changed", F.lit(True).alias("_done"))
    gate = resize_gate(F.col("length"))
    outcome = (
        F.when(gate != "resize", gate)
        .when(F.col("_done").isNull(), "missing")
        .when(F.col("error") == UNREADABLE, UNREADABLE)
        .when(F.col("error").isNotNull(), "failed")
        .when(F.col("changed"), "resized")
        .otherwise("unchanged")
    )
    return listing.join(done, "path", "left").select("path", "length", outcome.alias("outcome"), "width", "height")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n_files"))


def reorganise(spark: SparkSession, folder: str, store: str) -> tuple[DataFrame, DataFrame]:
    """Moves a folder tree needs to become a sharded store, and their counts."""
    moves = staged(reorganise_plan(list_files(spark, folder), store), "moves")
    return moves, action_counts(moves)


def quality_log(pairs: DataFrame) -> DataFrame:
    """``stem, mse, psnr, identical, error`` for rows of ``quality.all_paired``; nothing is measured where there is an error."""
    measured = with_psnr(pairs.withColumn("copy_px", F.when(F.col("error").isNull(), F.col("copy_px"))))
    return measured.select(stem_of(F.col("name")).alias("stem"), "mse", "psnr", "identical", "error")


def _pixels(images: DataFrame) -> DataFrame:
    """``name, px``: file names and band values; what can't be decoded has null ``px``."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                values = np.frombuffer(one.column("data")[0].as_py(), np.uint8).astype(np.int32)
                px = pa.ListArray.from_arrays([0, len(values)], pa.array(values))
                yield pa.RecordBatch.from_arrays([one.column("name"), px], names=["name", "px"])

    name = F.element_at(F.split(plain_path(F.col("origin")), "/"), -1)
    readable = F.coalesce((F.col("height") > 0) & (F.col("width") > 0), F.lit(False))
    decoded = images.filter(readable).select(name.alias("name"), "data")
    broken = images.filter(~readable).select(name.alias("name"), F.lit(None).cast("array<int>").alias("px"))
    return decoded.mapInArrow(unpack, "name string, px array<int>").unionByName(broken)


def quality_of_folders(spark: SparkSession, originals: str, copies: str, target: str) -> DataFrame:
    """Measure marked copies against the originals of the same name, and write a row for each image of either side;
    where a side is missing or damaged, the row has an ``error`` and no measure."""
    sides = [_pixels(read_images(spark, resolved(folder))) for folder in (originals, copies)]
    quality_log(all_paired(*sides)).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
