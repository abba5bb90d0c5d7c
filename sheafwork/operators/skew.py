"""Joins in which a few keys may own a large share of the rows.

Spark splits skewed join partitions by itself only where both sides come straight from an exchange;
a dimension that was just deduplicated keeps its partitioning and is left out. So heavy keys are
looked for first, with a one-row sketch, and only when there are any are their rows spread over
several tasks and the few dimension rows concerned repeated to match.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Items the sketch tracks for each key it may list, and at least; a million is the sketch's own limit.
_TRACKED_EACH, _TRACKED_LEAST, _TRACKED_MOST = 16, 1 << 14, 1_000_000
_SPREAD = "_spread"


@dataclass(frozen=True)
class Heavy:
    """Heavy keys of a column with the number of tasks each is spread over."""

    key: str
    tasks: tuple[tuple[object, int], ...]


def heavy_keys(df: DataFrame, *keys: str) -> dict[str, Heavy]:
    """Heavy keys of each column, found in one scan of these columns.

    A key is heavy when it would fill two average partitions or more, so there are at most half as many
    as partitions. The sketch may be off by a little, which changes how rows are spread, never the
    result.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(0.2, 2.0 / partitions)
    listed = math.ceil(1 / share)
    tracked = min(_TRACKED_MOST, max(_TRACKED_LEAST, _TRACKED_EACH * listed))
    sketches = [F.expr(f"approx_top_k(`{k}`, {listed}, {tracked})").alias(k) for k in keys]
    row = df.agg(F.count("*").alias("_rows"), *sketches).first()
    found = {}
    for k in keys:
        common = [(i["item"], i["count"] / row["_rows"]) for i in row[k] or [] if i["item"] is not None]
        found[k] = Heavy(k, tuple((v, max(2, math.ceil(s * partitions))) for v, s in common if s >= share))
    return found


def divided(df: DataFrame, heavy: Heavy) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys (and of no key), and rows of heavy keys."""
    listed = F.coalesce(F.col(heavy.key).isin([value for value, _ in heavy.tasks]), F.lit(False))
    return df.filter(~listed), df.filter(listed)


def spread_join(
    facts: DataFrame, dimension: DataFrame, heavy: Heavy, by: Column, how: str = "inner"
) -> DataFrame:
    """``facts`` joined with ``dimension`` (one row per key), heavy keys spread over tasks.

    ``by`` decides where a row of a heavy key goes. It must give the same value when a task runs
    again: a column that names the row, or the row number of an input that is read from files.
    """
    key = heavy.key
    if not heavy.tasks:
        return facts.join(dimension, key, how)
    kind = dimension.schema[key].dataType.simpleString()
    tasks = facts.sparkSession.createDataFrame(list(heavy.tasks), f"`{key}` {kind}, _tasks int")
    # At most half as many rows as there are partitions.
    listed = F.broadcast(tasks)
    n = F.coalesce("_tasks", F.lit(1))
    left = facts.join(listed, key, "left").withColumn(_SPREAD, F.pmod(F.xxhash64(by), n).cast("int")).drop("_tasks")
    right = (
        dimension.join(listed, key, "left")
        .withColumn(_SPREAD, F.explode(F.sequence(F.lit(0), n - 1)))
        .drop("_tasks")
    )
    return left.join(right, [key, _SPREAD], how).drop(_SPREAD)
