"""Metadata bundles: JSON objects that hold annotations, images, categories and institutions.

A bundle may be one document or many. A lone document is parsed by one task because JSON cannot be
cut; large metadata should be given as many documents (a folder, or one per line), which are read
in parallel and may repeat dimension rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.labels import last_wins
from ..operators.ordered import rank_in_key
from ..schemas import BUNDLE_2021, BUNDLE_2022


# Where a document stands among all: its file, the part of the file, and its place in that.
PLACE = "_place"


def read_bundles(spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """The documents, each with its place. Documents are in order of their files' paths, then as they stand in a file;
    the row number only orders rows of one part of a file, where it is the order of reading."""
    documents = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return documents.withColumn(PLACE, place)


def rows_of(bundles: DataFrame, part: str) -> DataFrame:
    """One row per element of an array of the bundle, with its ``position`` over all documents."""
    known = [PLACE] if PLACE in bundles.columns else []
    elements = bundles.select(*known, F.posexplode(part).alias("_at", "_row"))
    return elements.select(F.struct(*known, "_at").alias("position"), "_row.*")


def dimension(bundles: DataFrame, part: str, key: str) -> DataFrame:
    """Keyed rows of one array; of repeated keys the last one of the last document stays."""
    return last_wins(rows_of(bundles, part), key, ["position"])


def named_annotations(bundles: DataFrame) -> DataFrame:
    """Annotations with an ``id`` of their own: the image's, and a number from the second of an image on."""
    ranked = rank_in_key(rows_of(bundles, "annotations"), "image_id", ["position"], "_turn")
    turn = F.when(F.col("_turn") > 1, F.concat(F.lit("#"), F.col("_turn").cast("string"))).otherwise("")
    return ranked.withColumn("id", F.concat(F.col("image_id").cast("string"), turn)).drop("_turn", "position")


def star_2022(bundles: DataFrame) -> dict[str, DataFrame]:
    """Frames in the shape ``label_join_2022`` takes; these annotations come without a name of their own."""
    return {
        "annotations": named_annotations(bundles),
        "images": dimension(bundles, "images", "image_id"),
        "categories": dimension(bundles, "categories", "category_id"),
        "institutions": dimension(bundles, "institutions", "institution_id").withColumnRenamed(
            "collectionCode", "collection_code"
        ),
    }


def star_2021(bundles: DataFrame) -> dict[str, DataFrame]:
    """Frames in the shape ``label_join_2021`` takes."""
    return {
        "annotations": rows_of(bundles, "annotations").drop("position"),
        "images": dimension(bundles, "images", "id"),
        "categories": dimension(bundles, "categories", "id").withColumnRenamed("id", "category_id"),
        "institutions": dimension(bundles, "institutions", "id")
        .withColumnRenamed("id", "institution_id")
        .withColumnRenamed("name", "institution_name"),
    }


__all__ = ["BUNDLE_2021", "BUNDLE_2022", "dimension", "read_bundles", "rows_of", "star_2021", "star_2022"]
