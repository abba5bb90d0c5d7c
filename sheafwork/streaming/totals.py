"""Rolling error totals per host."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..sinks.buckets import BucketTable

_ERRORS = "errors bigint"


def rolling_errors(events: DataFrame) -> DataFrame:
    """Errors per host so far; ``events`` is a stream of ``attempts.host_events`` rows."""
    return events.filter(F.col("is_error") == 1).groupBy("host").agg(F.count("*").alias("errors"))


def put_totals(changed: DataFrame, trigger_no: int, path: str) -> None:
    """Replace the totals of the hosts a trigger changed; a trigger that runs again changes nothing."""
    rows = changed.select(F.col("host").alias("key"), "errors")
    BucketTable(changed.sparkSession, path, _ERRORS).put(rows, trigger_no)


def totals_writer(totals: DataFrame, path: str) -> DataStreamWriter:
    """Puts the hosts each trigger changed into the keyed table at ``path``, whose files stay few."""
    return totals.writeStream.outputMode("update").foreachBatch(lambda df, n: put_totals(df, n, path))


def latest_totals(spark: SparkSession, path: str) -> DataFrame:
    """Latest total of each host."""
    return BucketTable(spark, path, _ERRORS).latest().select(F.col("key").alias("host"), "errors")
