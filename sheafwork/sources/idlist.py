"""Id lists: text with one id per line, or tables in hash buckets (``sinks.checkpoint``)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evidence import clean_ids
from ..sinks.buckets import IMPORTED, BucketTable


def beside(path: str) -> str:
    """Where ids appended to a plain text list are kept."""
    return f"{path.rstrip('/')}.ids"


def is_table(spark: SparkSession, path: str) -> bool:
    return BucketTable(spark, path).exists()


def plain_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """Lines of a text file or folder as ``line``; None where there is nothing."""
    try:
        return spark.read.text(path).withColumnRenamed("value", "line")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines as ``line``; a list that does not exist yet is empty."""
    own = BucketTable(spark, path)
    if own.exists():
        return own.rows().select(F.col("key").alias("line"))
    lines = plain_lines(spark, path)
    if lines is None:
        return spark.createDataFrame([], "line string")
    appended = BucketTable(spark, beside(path))
    added = appended.rows().filter(F.col("added") != IMPORTED).select(F.col("key").alias("line"))
    return lines.unionByName(added) if appended.exists() else lines


def read_id_set(spark: SparkSession, path: str) -> DataFrame:
    return clean_ids(read_lines(spark, path))
