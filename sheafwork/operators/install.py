"""What to do with each id: record, refetch, fetch, or leave alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.store import REFETCH_BELOW_MB, size_mb, store_path
from .evidence import listed


def prior_ids(*earlier: DataFrame) -> DataFrame:
    """Ids of earlier datasets, each once."""
    ids = earlier[0].select("gbif_id")
    for more in earlier[1:]:
        ids = ids.unionAll(more.select("gbif_id"))
    return ids.filter(F.col("gbif_id").isNotNull()).distinct()


def duplicates(evidence: DataFrame) -> DataFrame:
    """Catalogue ids that an earlier dataset has."""
    return evidence.filter(listed() & F.col("prior"))


def planned(evidence: DataFrame) -> DataFrame:
    """Adds ``action`` to every catalogue id; the first rule that holds decides.

    The id lists come before the duplicate test, and a duplicate is not recorded as done.
    """
    too_small = size_mb(F.col("file_length")) < F.lit(REFETCH_BELOW_MB).cast("double")
    action = (
        F.when(F.col("done"), "done")
        .when(F.col("failed"), "failed")
        .when(F.col("prior"), "duplicate")
        .when(F.col("file_length").isNull(), "fetch")
        .when(too_small, "refetch")
        .otherwise("record_done")
    )
    return evidence.filter(listed()).withColumn("action", action)


def duplicate_removals(plan: DataFrame, store: str = "store") -> DataFrame:
    """Stored files of duplicates, to be removed."""
    present = plan.filter((F.col("action") == "duplicate") & F.col("file_length").isNotNull())
    return present.select("id", store_path(store, F.col("id")).alias("path"))
