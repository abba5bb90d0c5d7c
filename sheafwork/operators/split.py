"""Seeded split of exact size, decided row by row.

Rows are ordered by a hash of their id; the smallest fifth is the validation part. Instead of
ranking all rows, the hash value at the cut is found: rows are counted by hash prefix, the prefix
that holds the cut is picked from that small table, and so on inside the prefix until it holds few rows,
which are counted by their whole hash. The split itself is then a comparison and needs no exchange, unless the
cut goes through rows that share an id: those, and no others, are ranked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import exact_rank

# Share of the validation part and the seed.
VALIDATION_SHARE = 0.2
SEED = "42"
# Hash digits counted on at a time: 16 ** 4 prefixes bound the counting table.
_DIGITS = 4
# Rows of one prefix that are counted by whole hashes; a prefix with more is looked into by its next digits.
_RANKED = 100_000


@dataclass(frozen=True)
class Cut:
    """The hash at the cut, how many of its rows belong to the validation part, and how many rows have it."""

    key: str
    taken: int
    rows: int


def split_key(row_id: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(row_id.cast("string"), F.lit(f"|{seed}")))


def cut_key(rows: DataFrame, row_id: str = "id", share: float = VALIDATION_SHARE, seed: str = SEED) -> Cut | None:
    """The greatest hash that belongs to the validation part, and how many of the rows with it do; None of no rows."""
    near = rows.select(split_key(F.col(row_id), seed).alias("key")).filter(F.col("key").isNotNull())
    digits, place = _DIGITS, None
    while True:
        through = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        counted = (
            near.groupBy(F.substring("key", 1, digits).alias("prefix"))
            .agg(F.count("*").alias("n"))
            .select("prefix", "n", F.sum("n").over(through).alias("upto"), F.sum("n").over(whole).alias("total"))
        )
        share_of = F.ceil(F.col("total").cast("double") * F.lit(share).cast("double"))
        wanted = share_of if place is None else F.lit(place)
        held = counted.filter((F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted))
        row = held.select("prefix", "n", (wanted - F.col("upto") + F.col("n")).alias("place")).first()
        if row is None:
            return None
        if digits >= 32:
            return Cut(row["prefix"], row["place"], row["n"])
        near, place = near.filter(F.col("key").startswith(row["prefix"])), row["place"]
        # Few rows are counted by whole hashes at once.
        digits = 32 if row["n"] <= _RANKED else digits + _DIGITS


def with_split(
    rows: DataFrame,
    row_id: str = "id",
    share: float = VALIDATION_SHARE,
    seed: str = SEED,
    of: DataFrame | None = None,
) -> DataFrame:
    """Adds ``split``; the validation part has its exact size, also where rows share an id.

    ``of`` is a cheaper frame with the same ids to find the cut in, by default ``rows``. Rows are compared with the
    cut where they lie. Only if the cut goes through the rows of one id are those put in order, by a hash
    of all their columns; equal rows are interchangeable, so a rerun gives the same rows.
    """
    cut = cut_key(rows if of is None else of, row_id, share, seed)
    if cut is None:
        return rows.withColumn("split", F.lit("train"))
    key = split_key(F.col(row_id), seed)
    if cut.taken == cut.rows:
        return rows.withColumn("split", F.when(key <= cut.key, "val").otherwise("train"))
    at_cut = F.coalesce(key == cut.key, F.lit(False))
    sure = rows.filter(~at_cut).withColumn("split", F.when(key < cut.key, "val").otherwise("train"))
    named = rows.filter(at_cut).withColumn("_name", F.md5(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})))
    ranked = exact_rank(named, ["_name"], "_place")
    tied = ranked.withColumn("split", F.when(F.col("_place") <= cut.taken, "val").otherwise("train"))
    return sure.unionByName(tied.select(*rows.columns, "split"))
