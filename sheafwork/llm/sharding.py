"""Sharding by proportional stratified interleaving.

Within each source, rows are put in a seeded shuffled order and numbered; a row's fractional rank is
(number - 1/2) / rows of its source. All rows sorted by fractional rank are then cut into even runs, so
every shard holds each source in its share of the whole (to within a row per source) and shard sizes
differ by one row at most.

Both numberings are global: a range exchange of narrow rows and offsets per chunk, so a source that
owns a third of the rows is cut into as many chunks as any other rows. The first needs one more small
table: rows of each source per chunk, at most chunks + sources rows.

Defined results: a null source is a source of its own, a null text has size 1, a null doc_id sorts
first; repeated rows are rows of their own; ties of the shuffle are broken by doc_id, text checksum and
size, and rows equal in all of these can't be told apart; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import CHUNK, ROW, exact_rank, ordered_chunks
from ..staging import staged

SHARDS = 16
SEED = "shard"
_ORDER = ("source", "_shuffle", "doc_id", "text_crc32", "size")


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def source_ranks(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_rank``, the 1-based place in the shuffled order of their source, and ``_of``."""
    chunks = ordered_chunks(rows, _ORDER)
    held = chunks.groupBy("source", CHUNK).agg(F.count("*").alias("_held"), F.min(ROW).alias("_first"))
    # One row per source and chunk; sources are whole runs, so there are few.
    earlier = Window.partitionBy("source").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(
        held.select(
            F.col("source").alias("_s"),
            F.col(CHUNK).alias("_c"),
            "_first",
            F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_held").over(Window.partitionBy("source")).alias("_of"),
        ),
        "source-offsets",
    )
    joined = chunks.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col(CHUNK) == F.col("_c")))
    rank = F.col(ROW) - F.col("_first") + F.col("_before") + 1
    return joined.withColumn("_rank", rank).select(*rows.columns, "_rank", "_of")


def sharded(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """Per row: ``doc_id``, ``size`` (UTF-8 bytes plus one), ``text_crc32``, ``source``, ``shard``, ``slot``."""
    text = F.coalesce("text", F.lit(""))
    keyed = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    narrow = docs.select(
        "doc_id",
        "source",
        text_size(F.col("text")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(keyed.cast("binary")).alias("_shuffle"),
    )
    ranked = source_ranks(narrow).withColumn("_fraction", (F.col("_rank") - 0.5) / F.col("_of"))
    placed = exact_rank(ranked, ("_fraction", "source", "_rank"), "_place").withColumn("_n", F.lit(docs.count()))
    # Shard k holds the places from ceil(k * n / shards) on, counted from 0.
    cut = placed.withColumn("shard", F.expr(f"((_place - 1) * {shards}L) div _n"))
    first = F.expr(f"(shard * _n + {shards - 1}L) div {shards}L")
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        "source",
        F.col("shard").cast("int").alias("shard"),
        (F.col("_place") - 1 - first).alias("slot"),
    )
