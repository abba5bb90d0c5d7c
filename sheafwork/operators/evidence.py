"""What is known about each id, gathered from all id sources in one exchange.

Every source is reduced to the same narrow row and the union is aggregated by id. Rows are combined
before they are exchanged, so an id that owns a third of the catalogue costs one row per map task,
and no join can be skewed. Membership, intersection, union, difference and lookup counts are then
plain column logic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import as_id, strip
from ..functions.store import stem_of, store_path


def clean_ids(lines: DataFrame, column: str = "line") -> DataFrame:
    """Id list: stripped, blanks dropped, each id once."""
    return (
        lines.select(strip(F.col(column)).alias("id")).filter(F.length("id") > 0).distinct()
    )


def _evidence(
    df: DataFrame,
    key: Column,
    *,
    listed: bool = False,
    done: bool = False,
    failed: bool = False,
    prior: bool = False,
    length: Column | None = None,
) -> DataFrame:
    return df.select(
        key.alias("id"),
        F.lit(int(listed)).cast("bigint").alias("n_urls"),
        F.lit(done).alias("done"),
        F.lit(failed).alias("failed"),
        F.lit(prior).alias("prior"),
        (F.lit(None) if length is None else length).cast("bigint").alias("file_length"),
    )


def id_evidence(
    catalogue: DataFrame,
    done: DataFrame | None = None,
    failed: DataFrame | None = None,
    prior: list[DataFrame] | None = None,
    inventory: DataFrame | None = None,
    store: str = "store",
) -> DataFrame:
    """One row per id (and one for catalogue rows without id): ``id, n_urls, done, failed, prior, file_length``.

    ``done`` and ``failed`` are raw id lists. A file of the inventory counts for an id when it lies
    at that id's place in the store; the place names the id, so no join on paths is needed.
    """
    parts = [_evidence(catalogue, as_id(F.col("gbif_id")), listed=True)]
    for lines, flag in ((done, "done"), (failed, "failed")):
        if lines is not None:
            ids = strip(F.col("line"))
            parts.append(_evidence(lines.filter(F.length(ids) > 0), ids, **{flag: True}))
    for earlier in prior or []:
        known = earlier.filter(F.col("gbif_id").isNotNull())
        parts.append(_evidence(known, as_id(F.col("gbif_id")), prior=True))
    if inventory is not None:
        stem = stem_of(F.col("path"))
        placed = inventory.filter(F.col("path") == store_path(store, stem))
        parts.append(_evidence(placed, stem, length=F.col("length")))
    return (
        reduce(DataFrame.unionAll, parts)
        .groupBy("id")
        .agg(
            F.sum("n_urls").alias("n_urls"),
            F.bool_or("done").alias("done"),
            F.bool_or("failed").alias("failed"),
            F.bool_or("prior").alias("prior"),
            F.max("file_length").alias("file_length"),
        )
    )


def listed() -> Column:
    """The id is in the catalogue. Null-id rows are counted, but are no id."""
    return F.col("id").isNotNull() & (F.col("n_urls") > 0)


def remaining(evidence: DataFrame) -> DataFrame:
    """Catalogue ids neither done nor failed."""
    return evidence.filter(listed() & ~F.col("done") & ~F.col("failed"))
