"""Quality rules: base rules per text, and a hashed n-gram log-likelihood ratio.

Runs of words (``sizes``: pairs, or single words and pairs as the query has it) are hashed into buckets.
Two multinomials are counted over them: one over the trusted documents (labelled good and not toxic), one
over the whole corpus. A document's score is the mean over its runs of log(p_trusted / p_raw); it is kept
when the score is not below the threshold: a number of nats, or what all but ``LOST_PERCENT`` of held-out
trusted documents reach. Held out is a share of one in ``FOLDS`` by doc_id, left out of the trusted counts.
Log ratios are whole multiples of 2^-20, so that a sum does not depend on its order and every document
gets the same verdict on every run. Only DataFrame functions are used; both multinomials are one small
aggregate of ``BUCKETS`` rows, and scoring reads them as one array.

Defined results: a null or wordless text has no words, fails the base rules and has a null score; a
null doc_id is never trusted; repeated document rows are rows of their own; repeated labels count once
(one bad label outweighs good ones); with no trusted document all log ratios are those of equal
multinomials smoothed; with no held-out document that passes the base rules the threshold is ``THRESHOLD``;
with an empty table the result is empty. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import staged
from .words import SEPARATOR_PATTERN

BUCKETS = 1 << 14
PAIR = 2
SIZES = (1, PAIR)
SCALE = 1 << 20
# Nats per n-gram: below it, the raw corpus explains a document e^0.1 times better per n-gram.
THRESHOLD = -0.1
FOLDS, LOST_PERCENT = 5, 1
# Held-out scores are counted in steps of 1 / STEPS nats.
STEPS = 1 << 12
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
_SPACES = " \t\n\x0b\x0c\r"
# The characters that count as symbols.
_SYMBOLS = "[#*$%&|<>]"


def words_of(text: Column) -> Column:
    """Array of words; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR_PATTERN), "")


def run_hashes(hashed: Column, n: int) -> Column:
    """Hash of every run of ``n`` words, from the array of word hashes."""
    runs = F.transform(hashed, lambda h, i: F.xxhash64(h, *[F.get(hashed, i + k) for k in range(1, n)]))
    return F.slice(runs, 1, F.greatest(F.size(hashed) - (n - 1), F.lit(0)))


def buckets_of(hashed: Column, sizes: tuple[int, ...] = (PAIR,)) -> Column:
    """Buckets of all runs of ``sizes`` words, from the array of word hashes."""
    runs = F.concat(*[run_hashes(hashed, n) for n in sizes])
    return F.transform(runs, lambda h: h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))


def hashed_words(docs: DataFrame, *keep: str) -> DataFrame:
    words = docs.select(*keep, words_of(F.col("text")).alias("words"))
    return words.withColumn("hashed", F.transform("words", lambda w: F.xxhash64(w)))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` of documents that are labelled good and never bad or toxic, once each."""
    verdicts = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
    judged = verdicts.agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    return judged.filter("quality = 1 AND toxic = 0").select("doc_id")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == FOLDS - 1


def log_ratios(docs: DataFrame, trusted: DataFrame, sizes: tuple[int, ...] = (PAIR,)) -> DataFrame:
    """One row with ``ratios``: per bucket, 2^20 times log(p_trusted / p_raw), add-one smoothed.

    The aggregate has at most ``BUCKETS`` rows, whatever the corpus.
    """
    # The same plan at every size: the trusted side has no bound.
    known = trusted.withColumn("_trusted", F.lit(1)).hint("merge")
    marked = docs.select("doc_id", "text").join(known, "doc_id", "left")
    grams = hashed_words(marked, "_trusted").select("_trusted", F.explode(buckets_of(F.col("hashed"), sizes)).alias("bucket"))
    counted = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("_trusted").alias("good"))
    counted = staged(counted, "quality-counts")
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counted, "bucket", "left").na.fill(0)
    entry = F.struct("bucket", "raw", "good")
    table = full.agg(
        F.sort_array(F.collect_list(entry)).alias("t"), F.sum("raw").alias("n_raw"), F.sum("good").alias("n_good")
    )

    def ratio(e: Column) -> Column:
        log_good = F.log((e["good"] + 1) / (F.col("n_good") + BUCKETS))
        log_raw = F.log((e["raw"] + 1) / (F.col("n_raw") + BUCKETS))
        return F.round((log_good - log_raw) * SCALE).cast("bigint")

    return table.select(F.transform("t", ratio).alias("ratios"))


def base_rules(text: Column, words: Column, halves: Column) -> dict[str, Column]:
    """Counts of the base rules. ``halves`` holds the hash of every run of ``WINDOW / 2`` words."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(_SPACES)) != "")
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.char_length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": F.regexp_count(whole, F.lit(_SYMBOLS)).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        "n_repeat_words": repeated_words(halves).cast("bigint"),
    }


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(halves: Column) -> Column:
    """Number of words inside windows of ``WINDOW`` words that occur twice or more.

    ``halves`` holds the hash of every run of half a window. A repeated window repeats all half
    windows it holds, so a text with fewer repeated halves than that has none, which is the usual
    case. For the rest, windows are sorted with their positions, those equal to a neighbour are kept,
    and the union of the word ranges they cover is measured in order of position.
    """
    half = WINDOW // 2
    whole = F.slice(
        F.transform(halves, lambda h, i: F.xxhash64(h, F.get(halves, i + half))),
        1,
        F.greatest(F.size(halves) - half, F.lit(0)),
    )
    placed = F.sort_array(F.transform(whole, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(p: Column) -> Column:
        equal = F.transform(p, lambda a, k: F.when(a["h"] == F.get(p, k + 1)["h"], F.array(a["i"], F.get(p, k + 1)["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda e: e.isNotNull()))))

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        _bound(placed, places),
        start,
        lambda acc, p: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), p + WINDOW - acc["end"])).alias("n"), (p + WINDOW).alias("end")
        ),
        lambda acc: acc["n"],
    )
    repeats = F.size(halves) - F.size(F.array_distinct(halves))
    return F.when(repeats < half + 1, F.lit(0)).otherwise(covered)


def held_out_threshold(scored: DataFrame, held: DataFrame) -> DataFrame:
    """One row with ``threshold``: ``LOST_PERCENT`` of the scores of held-out documents at most are below it.

    Counted in steps, so the row is exact and as small for any number of documents.
    """
    reached = scored.filter("NOT base_failed AND score IS NOT NULL").join(held, "doc_id", "left_semi")
    counted = reached.groupBy(F.floor(F.col("score") * STEPS).alias("step")).agg(F.count("*").alias("n"))
    table = counted.agg(F.sort_array(F.collect_list(F.struct("step", "n"))).alias("t"), F.sum("n").alias("total"))
    start = F.struct(F.lit(0).cast("bigint").alias("below"), F.lit(None).cast("bigint").alias("step"))

    def further(acc: Column, e: Column) -> Column:
        fits = 100 * acc["below"] <= LOST_PERCENT * F.col("total")
        return F.struct((acc["below"] + e["n"]).alias("below"), F.when(fits, e["step"]).otherwise(acc["step"]).alias("step"))

    found = F.aggregate("t", start, further, lambda acc: acc["step"])
    return table.select(F.coalesce(found / STEPS, F.lit(THRESHOLD)).alias("threshold"))


def judged(
    docs: DataFrame, labels: DataFrame, sizes: tuple[int, ...] = (PAIR,), threshold: float | None = THRESHOLD
) -> DataFrame:
    """Per document: base counts, ``base_failed``, ``score`` and ``kept``.

    Two passes over the texts: one counts the multinomials (the one exchange of texts, by doc_id, marks
    the trusted ones), one judges every document where it lies. Without a ``threshold`` it is taken from
    held-out trusted documents.
    """
    trusted = trusted_ids(labels)
    taught = trusted if threshold is not None else trusted.filter(~held_out(F.col("doc_id")))
    ratios = log_ratios(docs, taught, sizes)
    hashed = hashed_words(docs, "doc_id", "text")
    ready = hashed.select(
        "doc_id",
        "text",
        "words",
        run_hashes(F.col("hashed"), WINDOW // 2).alias("halves"),
        buckets_of(F.col("hashed"), sizes).alias("buckets"),
    )
    # One row: the array of log ratios.
    weighed = ready.withColumn("ratios", ratios.scalar())
    total = F.aggregate(
        "buckets", F.lit(0).cast("bigint"), lambda acc, b: acc + F.get("ratios", b)
    )
    rules = base_rules(F.col("text"), F.col("words"), F.col("halves"))
    counted = weighed.select(
        "doc_id",
        *[c.alias(n) for n, c in rules.items()],
        F.when(F.size("buckets") > 0, total / F.size("buckets") / SCALE).alias("score"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    scored = counted.withColumn("base_failed", failed)
    least = F.lit(threshold)
    if threshold is None:
        scored = staged(scored, "quality-scores")
        least = held_out_threshold(scored, trusted.filter(held_out(F.col("doc_id")))).scalar()
    verdict = F.coalesce(F.col("score") >= least, F.lit(False))
    return scored.withColumn("kept", ~F.col("base_failed") & verdict)
