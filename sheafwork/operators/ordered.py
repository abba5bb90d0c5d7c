"""Ordered work over data in which one key may own a large share of all rows.

Rows of ordinary keys go through a window partitioned by the key. Rows of heavy keys (``skew``)
would all end up in one task that way. They are put in order by one range exchange instead, which
cuts between rows and so also cuts a key into many even chunks. That layout is pinned, each chunk
is worked through as a stream, and what has to be handed from one chunk to the next is computed
from a summary table. Only the key a chunk starts with can have begun in an earlier chunk, so the
hand-over table never has more rows than there are chunks: that bound is what allows it to be
broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import pinned, staged
from .skew import Heavy, divided, heavy_keys

CHUNK, ROW, CARRY = "_chunk", "_row", "_carry"
_ROW_BITS = (1 << 33) - 1


def ordered_chunks(df: DataFrame, order: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """Rows in global order of ``order``, with chunk number and row number inside the chunk.

    Columns outside ``keep`` are dropped once the rows are in order. Pinned, because the bounds of a
    range exchange are sampled anew on every run and all consumers must see the same chunks.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).select(*(keep or df.columns))
    return pinned(
        ranged.withColumn(CHUNK, F.spark_partition_id()).withColumn(
            ROW, F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
        )
    )


def exact_rank(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Exact 1-based position of every row in the global order; no single-task sort of the rows."""
    return _with_offsets(ordered_chunks(df, order), name)


def written_rank(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """As ``exact_rank``, of rows that are written once, as Parquet in their order, and read by whoever follows.

    The numbers inside a chunk are written with the rows; the chunks' offsets are added as the rows are read, so wide
    rows have one copy, of which each reader takes its own columns.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranged.withColumns(
        {CHUNK: F.spark_partition_id(), ROW: F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))}
    )
    return _with_offsets(staged(numbered, "ranked"), name)


def _with_offsets(chunks: DataFrame, name: str) -> DataFrame:
    earlier = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    # One row per chunk.
    offsets = (
        chunks.groupBy(CHUNK)
        .agg(F.count("*").alias("n"))
        .select(CHUNK, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        chunks.join(F.broadcast(offsets), CHUNK)
        .withColumn(name, F.col("_before") + F.col(ROW) + 1)
        .drop(CHUNK, ROW, "_before")
    )


def edge_rows(chunks: DataFrame, key: str) -> DataFrame:
    """Rows of the first and the last key of each chunk: only these keys can cross a chunk border."""
    edges = (
        chunks.groupBy(CHUNK)
        .agg(F.min_by(key, ROW).alias("first"), F.max_by(key, ROW).alias("last"))
        .select(CHUNK, F.explode(F.array_distinct(F.array("first", "last"))).alias(key))
    )
    # At most two rows per chunk.
    return chunks.join(F.broadcast(edges), [CHUNK, key], "left_semi")


def hand_over(summary: DataFrame, key: str, carry: Callable[[Window], Column]) -> DataFrame:
    """Value each chunk inherits for the key it starts with.

    ``summary`` has one row per chunk and edge key; ``carry`` gets the window of earlier chunks of the
    same key. Keys that live in one chunk only yield null and are dropped.
    """
    inherited = carry(_earlier_rows(key, [CHUNK]))
    return summary.select(CHUNK, key, inherited.alias(CARRY)).filter(F.col(CARRY).isNotNull())


def with_carry(chunks: DataFrame, carry: DataFrame, key: str, name: str = CARRY) -> DataFrame:
    """Attach the hand-over value; at most one row per chunk is broadcast."""
    return chunks.join(F.broadcast(carry.withColumnRenamed(CARRY, name)), [CHUNK, key], "left")


class KeyRuns:
    """Start positions of key runs over the batches of one chunk."""

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)
        self.last: tuple | None = None

    def starts(self, batch: pd.DataFrame) -> tuple[np.ndarray, bool]:
        """Start index of each row's run, and whether the first run goes on from the last batch."""
        n = len(batch)
        fresh = np.zeros(n, dtype=bool)
        for k in self.keys:
            values = batch[k].to_numpy()
            fresh[1:] |= values[1:] != values[:-1]
        first = tuple(batch[k].iloc[0] for k in self.keys)
        continued = self.last is not None and first == self.last
        fresh[0] = True
        self.last = tuple(batch[k].iloc[-1] for k in self.keys)
        return np.maximum.accumulate(np.where(fresh, np.arange(n), 0)), continued


    def spans(self, batch: pd.DataFrame) -> list[tuple[int, int, bool]]:
        """``(from, to, goes on from the last batch)`` for each run of the batch."""
        start, continued = self.starts(batch)
        borders = [*np.unique(start).tolist(), len(batch)]
        return [(lo, hi, lo == 0 and continued) for lo, hi in zip(borders, borders[1:])]


def _field_list(df: DataFrame, *added: T.StructField) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name not in (CHUNK, ROW, CARRY)]
    return T.StructType([*kept, *added])


def _by_weight(
    df: DataFrame,
    key: str,
    heavy: Heavy | None,
    ordinary: Callable[[DataFrame], DataFrame],
    chunked: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    heavy = heavy or heavy_keys(df, key)[key]
    if not heavy.tasks:
        return ordinary(df)
    light, massive = divided(df, heavy)
    return ordinary(light).unionByName(chunked(massive))


def _earlier_rows(key: str, order: Sequence[str]) -> Window:
    return Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def running_count(
    df: DataFrame, key: str, order: Sequence[str], counted: str, name: str, heavy: Heavy | None = None
) -> DataFrame:
    """Number of earlier rows of the same key for which the 0/1 column ``counted`` is 1."""
    before = F.coalesce(F.sum(counted).over(_earlier_rows(key, order)), F.lit(0)).cast("bigint")
    return _by_weight(
        df,
        key,
        heavy,
        lambda rows: rows.withColumn(name, before),
        lambda rows: chunked_count(rows, key, order, counted, name),
    )


def chunked_count(
    df: DataFrame, key: str, order: Sequence[str], counted: str, name: str, keep: Sequence[str] | None = None
) -> DataFrame:
    chunks = ordered_chunks(df, [key, *order], keep)
    totals = edge_rows(chunks, key).groupBy(CHUNK, key).agg(F.sum(counted).cast("bigint").alias("n"))
    carried = with_carry(chunks, hand_over(totals, key, lambda w: F.sum("n").over(w)), key)
    schema = _field_list(chunks, T.StructField(name, T.LongType()))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs, so_far = KeyRuns([key]), 0
        for batch in batches:
            if batch.empty:
                continue
            start, continued = runs.starts(batch)
            ones = batch[counted].to_numpy(dtype=np.int64)
            through = np.cumsum(ones)
            before = through - ones
            value = before - before[start] + batch[CARRY].fillna(0).to_numpy(dtype=np.int64)
            if continued:
                first_run = start == 0
                value[first_run] = before[first_run] + so_far
            so_far = int(value[-1] + ones[-1])
            batch[name] = value
            yield batch[schema.fieldNames()]

    return carried.mapInPandas(count, schema)


def rank_in_key(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    name: str,
    heavy: Heavy | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """1-based position of a row among the rows of its key.

    Columns in ``drop`` are only there to order by. The order should tell all rows apart: rows that
    are equal in it cannot be cut into chunks.
    """
    position = F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("bigint")
    kept = [c for c in df.columns if c not in drop]

    def chunked(rows: DataFrame) -> DataFrame:
        counted = chunked_count(rows.withColumn("_one", F.lit(1)), key, order, "_one", "_earlier", [*kept, "_one"])
        return counted.withColumn(name, F.col("_earlier") + 1).drop("_one", "_earlier")

    return _by_weight(df, key, heavy, lambda rows: rows.withColumn(name, position).drop(*drop), chunked)


def last_before(
    df: DataFrame, key: str, order: Sequence[str], value: str, name: str, heavy: Heavy | None = None
) -> DataFrame:
    """Latest non-null ``value`` (a long) among the earlier rows of the same key."""
    latest = F.last(value, ignorenulls=True).over(_earlier_rows(key, order))
    return _by_weight(
        df,
        key,
        heavy,
        lambda rows: rows.withColumn(name, latest),
        lambda rows: chunked_last(rows, key, order, value, name),
    )


def chunked_last(df: DataFrame, key: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    chunks = ordered_chunks(df, [key, *order])
    latest = edge_rows(chunks, key).groupBy(CHUNK, key).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(ROW))).alias("v")
    )
    carry = hand_over(latest, key, lambda w: F.last("v", ignorenulls=True).over(w))
    carried = with_carry(chunks, carry, key)
    schema = _field_list(chunks, T.StructField(name, T.LongType()))

    def look_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs, held = KeyRuns([key]), pd.NA
        for batch in batches:
            if batch.empty:
                continue
            start, continued = runs.starts(batch)
            values = batch[value].astype("Int64").reset_index(drop=True)
            at = np.maximum.accumulate(np.where(values.notna(), np.arange(len(batch)), -1))
            previous = np.append(-1, at[:-1])
            result = batch[CARRY].astype("Int64").reset_index(drop=True)
            if continued:
                result = result.mask(start == 0, held)
            result = result.mask(previous >= start, values.take(np.maximum(previous, 0)).reset_index(drop=True))
            held = result.iloc[-1] if pd.isna(values.iloc[-1]) else values.iloc[-1]
            batch[name] = result.to_numpy(dtype=object, na_value=None)
            yield batch[schema.fieldNames()]

    return carried.mapInPandas(look_back, schema)
