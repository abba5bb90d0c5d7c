"""The sharded store: content rows under ``prefix1=/prefix2=``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.store import prefix1, prefix2


def write_store(rows: DataFrame, path: str, mode: str = "append", id_column: str = "gbif_id") -> None:
    """Write rows (id and content) as Parquet, partitioned by the two prefixes of the id.

    A range exchange on prefixes and id gives each task few folders and cuts a crowded prefix over
    several tasks.
    """
    stem = F.col(id_column).cast("string")
    placed = rows.withColumn("prefix1", prefix1(stem)).withColumn("prefix2", prefix2(stem))
    placed.repartitionByRange("prefix1", "prefix2", id_column).write.mode(mode).partitionBy("prefix1", "prefix2").parquet(path)


def read_store(spark, path: str, schema) -> DataFrame:
    """Rows of the store; a filter on the prefixes reads only their folders."""
    return spark.read.schema(schema).parquet(path)
