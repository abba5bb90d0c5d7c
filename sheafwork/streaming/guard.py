"""Host cooldown and breaker as attempts arrive.

A trigger's attempts are replayed like a log (``operators.guard``), from what is known of their hosts: the rest in force
and the errors so far. A host that owns much of a trigger is cut into chunks there, so it needs no task of its own
size. What arrives in a later trigger is decided later, whatever its time, because the state only knows what has arrived.

State is a table in hash buckets (``sinks.buckets``) versioned by the trigger's number, of which a trigger reads the
buckets of its hosts. Decisions are written first, the state is switched after them: a trigger that runs again before
the switch starts from the same state and writes the same decisions over, and one that runs again after it does nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.http import BREAKER_ERRORS
from ..operators.guard import REPLAYED, SEED_ERRORS, SEED_REST, replay_rows
from ..sinks.buckets import BucketTable

_STATE = "errors bigint, resting bigint"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def host_states(spark: SparkSession, path: str) -> BucketTable:
    return BucketTable(spark, f"{path}/hosts", _STATE)


def decide_trigger(events: DataFrame, trigger_no: int, path: str, threshold: int = BREAKER_ERRORS) -> None:
    """Decide a trigger's attempts and carry the state of its hosts on."""
    spark, table = events.sparkSession, host_states(events.sparkSession, path)
    version = table.version()
    if trigger_no <= version.batch:
        return
    arrived = events.select("host", "ts_us", "attempt_id", "is_error", "rest_us").persist()
    try:
        bucket = table.bucket_of(F.col("host"), version.buckets)
        touched = [r["bucket"] for r in arrived.select(bucket.alias("bucket")).distinct().collect()]
        known = table.newest(table.rows(version, touched))
        seeds = known.select(F.col("key").alias("host"), F.col("resting").alias(SEED_REST), F.col("errors").alias(SEED_ERRORS))
        target = f"{path}/decisions/trigger_no={trigger_no}"
        replay_rows(arrived, threshold, seeds=seeds).write.mode("overwrite").parquet(target)
    finally:
        arrived.unpersist()
    changed = spark.read.schema(REPLAYED).parquet(target).groupBy(F.col("host").alias("key"))
    # A rest never moves back, so the greatest is the last.
    now = changed.agg(F.sum("sent_error").alias("_sent"), F.max("until").alias("_until"))
    carried = now.join(seeds, F.col("key").eqNullSafe(F.col("host")), "left").select(
        "key",
        (F.coalesce(SEED_ERRORS, F.lit(0)) + F.col("_sent")).alias("errors"),
        F.greatest(SEED_REST, "_until").alias("resting"),
    )
    table.put(carried, trigger_no)


def guard_writer(events: DataFrame, path: str, threshold: int = BREAKER_ERRORS) -> DataStreamWriter:
    """``events`` is a stream of ``attempts.host_events`` rows; decisions and state go below ``path``.

    Bound a trigger at the source (``maxFilesPerTrigger``, ``maxBytesPerTrigger``): it is kept while it is decided.
    """
    return events.writeStream.foreachBatch(lambda df, n: decide_trigger(df, n, path, threshold))


def decisions(spark: SparkSession, path: str) -> DataFrame:
    """``attempt_id``, ``decision`` of every trigger."""
    written = spark.read.schema(f"{REPLAYED}, trigger_no bigint").parquet(f"{path}/decisions")
    return written.select("attempt_id", "decision")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session is left as it was."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)
