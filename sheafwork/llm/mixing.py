"""Mixing sources to target weights.

Tokens are added up per source; a water level turns the weights into a target per source; target over
size is the source's repetition rate. A document is emitted floor(rate) times, and once more if a hash
of the seed and its id falls below the fraction. Only DataFrame functions are used.

Defined results: a null text counts no tokens; a null source is a source of its own, last in order; a
null doc_id is hashed as the text ``null``; repeated rows share their id's draw; a source without
tokens gets target 0 and rate 0; an empty table gives an empty table. Other columns pass through
untouched; columns this operator adds replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged
from .words import WORD_PATTERN

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2.0
SEED = "mix"
# A table of that many sources is some 2 MB; more are joined by exchange.
BROADCAST_SOURCES = 20_000
_DRAW_DIGITS = 13
_ABSENT = "_source_absent"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> DataFrame:
    """Per source: ``source``, ``source_size``, ``target``, ``rate``.

    ``sizes`` has ``source`` and ``size``. Sources in code point order (null last) weigh ``weights`` in
    turn and share ``share`` of all tokens; no target is above ``limit`` times its source's size. The
    excess of full sources goes to the others by weight, so there is one level L with
    target = min(limit * size, L * weight). Sorted by the level at which they fill up, the sources that
    are full form a prefix: the longest whose last source is full at the level the rest would get.
    The windows run over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = per_source.select(
        "source",
        "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1).alias("_weight"),
        (F.col("source_size") * limit).alias("_most"),
        (F.sum("source_size").over(everything) * share).alias("_budget"),
    )
    filling = Window.orderBy(F.col("_most") / F.col("_weight"), F.col("source").isNull(), F.col("source"))
    upto, fromhere = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("_budget") - F.coalesce(F.sum("_most").over(upto), F.lit(0.0))) / F.sum("_weight").over(fromhere)
    levels = weighed.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("_weight") < F.col("_most"))
    # The level of the first source that does not fill up; none if the budget fills all.
    final = F.first(F.when(F.col("_open"), F.col("_level")), ignorenulls=True).over(
        filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.coalesce(F.least("_most", final * F.col("_weight")), F.col("_most"))
    return levels.withColumn("target", target).select(
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(limit)))
        .otherwise(0.0)
        .alias("rate"),
    )


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 that depends on seed and id alone."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    digits = F.substring(F.md5(named.cast("binary")), 1, _DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16**_DRAW_DIGITS)


def with_copies(docs: DataFrame, seed: str = SEED, **targets) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, the times a document is taken.

    A hot source is no obstacle: its tokens are added up before the exchange, and the join is a
    broadcast while the sources number ``BROADCAST_SOURCES`` at most.
    """
    sized = docs.withColumn("size", token_count(F.col("text")))
    rates = staged(source_targets(sized.select("source", "size"), **targets), "mixing-rates")
    few = rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    rates = rates.select(F.col("source").alias(_ABSENT), "source_size", "target", "rate")
    kept = sized.drop("source_size", "target", "copies", "rate")
    joined = kept.join(F.broadcast(rates) if few else rates, F.col("source").eqNullSafe(F.col(_ABSENT)))
    whole = F.floor("rate")
    extra = (draw(F.col("doc_id"), seed) < F.col("rate") - whole).cast("int")
    return joined.withColumn("copies", (whole + extra).cast("int")).drop(_ABSENT, "rate")


def mixed(docs: DataFrame, seed: str = SEED, **targets) -> DataFrame:
    """The mixture itself: every document as often as it is taken, with the columns of ``docs``."""
    packed = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("_row"))
    times = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies")))
    repeated = with_copies(packed, seed, **targets).select("_row", F.explode(times).alias("_copy"))
    return repeated.select("_row.*")
