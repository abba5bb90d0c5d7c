"""Exactly-once id list fed by a stream.

Each trigger adds the ids no earlier trigger has added, into the hash buckets they belong to, and writes its number
into the table's manifest with the same switch. A trigger that runs again finds its number there, or starts over;
either way a restart neither loses nor repeats any. It reads the buckets it has ids for and no others. Streaming
``dropDuplicates`` would keep every id in state for ever; here they are on disk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..sinks.checkpoint import append_ids, table_of


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """``id`` and the number of the trigger it came with."""
    return table_of(spark, path).rows().select(F.col("key").alias("id"), F.col("added").alias("trigger_no"))


def append_trigger(ids: DataFrame, trigger_no: int, path: str) -> None:
    append_ids(ids, path, trigger_no)


def id_list_writer(ids: DataFrame, path: str) -> DataStreamWriter:
    """Writer for a stream of ``id``; the caller sets checkpoint location and trigger and starts it."""
    return ids.writeStream.foreachBatch(lambda df, n: append_trigger(df, n, path))
