"""Where intermediate data is pinned: the shared folder the cluster names.

``spark.checkpoint.dir`` is read from the session. Only a local session without that setting gets
a folder of its own, because a machine-local folder would be lost with its executor.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    active = context.getCheckpointDir()
    if not (named or active):
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="sheafwork-")
    if not active:
        context.setCheckpointDir(named)
    return (named or active).rstrip("/")


def stage_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder; nothing is ever overwritten there."""
    return f"{shared_dir(spark)}/sheafwork/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """Cut the lineage and fix the partition layout with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    For rows with several consumers: each consumer prunes its own columns from the written table
    and Spark knows the table's size when it picks join strategies.
    """
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
