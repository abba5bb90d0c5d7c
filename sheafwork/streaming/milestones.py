"""Progress milestones as completions arrive.

Each trigger counts its completions once; its first ordinal follows from the counts of earlier
triggers. Counts and milestones are written per trigger, so a trigger that runs again gives the
same rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.attempts import milestones
from ..staging import staged

_COUNTS = "n bigint, trigger_no bigint"
_MILESTONES = "ordinal bigint, gbif_id bigint, trigger_no bigint"


def _stored_before(spark: SparkSession, path: str, trigger_no: int) -> int:
    """Completions of earlier triggers: one number."""
    try:
        counts = spark.read.schema(_COUNTS).parquet(f"{path}/counts")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return counts.filter(F.col("trigger_no") < trigger_no).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def milestones_writer(completions: DataFrame, path: str, every: int, stored: int = 0) -> DataStreamWriter:
    """``completions`` is a stream of ``gbif_id, attempt_id, ts_us``."""

    def write(df: DataFrame, n: int) -> None:
        spark = df.sparkSession
        before = stored + _stored_before(spark, path, n)
        rows = staged(df, "completions")
        rows.agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/counts/trigger_no={n}")
        reached = milestones(rows, every, before)
        reached.write.mode("overwrite").parquet(f"{path}/milestones/trigger_no={n}")

    return completions.writeStream.foreachBatch(write)


def reached(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_MILESTONES).parquet(f"{path}/milestones").select("ordinal", "gbif_id")
