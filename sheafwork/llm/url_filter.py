"""URL filters: rules on hosts and paths, and a list of canonical URLs behind a blocked Bloom filter.

A list may hold far more URLs than a task can, while few of the pages are on it. So the listed URLs set bits
in a blocked Bloom filter: a hash picks one block of 256 bits, and one bit in each of its eight words. The filter
has ``MOST_BLOCKS`` blocks at most, which bounds what is broadcast, however long the list grows; a fuller filter lets
more pages pass, never fewer. Pages that miss a bit are not listed and go no further. The others are possible
hits: they meet the list in an exact join over whole canonical URLs, which removes the false positives.

Only DataFrame functions are used.

The canonical form of a URL leaves out what does not change the page: the scheme, capitals A-Z of the host, the default
port, ``www.`` in front, the fragment, tracking parameters (``utm_`` and those of ``TRACKING``) and slashes at the
end of the path; other parameters are sorted.

Rules are (host, path, verdict). A rule fits its host and all subdomains if the path starts with the rule's; the
longest (host and path together, then host) wins, and a fitting rule overrides the list.

Defined results: a URL that is null or has no ``://`` has empty host and path, no canonical form, and is allowed unless a
rule for the empty host fits; an empty host on the list is ignored; repeated rows get equal answers; repeated list entries
count once; an empty list allows, an empty table gives an empty table; other columns pass through untouched and
columns this operator adds replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import staged

ALLOW, BLOCK = "allow", "block"
WORDS, BITS_PER_KEY = 8, 16
# 4 MB of bits: good for two million listed URLs at full accuracy, and right for any number.
MOST_BLOCKS = 1 << 17
# Parameters that name where a reader came from.
TRACKING = ("ref", "fbclid", "gclid")
# Words that put the URLs of a host on the list of ``listed_by_words``.
BLOCKED_WORDS = ("casino", "bets", "ads", "spam", "pills", "adult")
RULES = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_AFTER = r"(?s)^.*?://"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    host = F.regexp_extract(url, _AFTER + "([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _AFTER + "[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling of a URL; null for one without a host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), ":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(url, _AFTER + r"[^?#]*\?([^#]*)", 1)
    told = F.split(query, "&")
    name = lambda p: F.substring_index(p, "=", 1)
    kept = F.filter(told, lambda p: (p != "") & ~name(p).startswith("utm_") & ~name(p).isin(*TRACKING))
    rest = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(host, path, F.when(rest != "", F.concat(F.lit("?"), rest)).otherwise(""))
    return F.when(host != "", whole)


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Name (host and path) and verdict of the rule that decides; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own, start, says in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        name, verdict = F.when(fits, F.lit(own + start)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def listed_by_words(urls: DataFrame, words: Sequence[str] = BLOCKED_WORDS) -> DataFrame:
    """``canonical`` of every URL whose host has one of the words between dots and hyphens."""
    parts = F.split(host_of(F.col("url")), "[.-]")
    return urls.filter(F.arrays_overlap(parts, F.array(*[F.lit(w) for w in words]))).select(
        canonical(F.col("url")).alias("canonical")
    )


def _slot(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """The bit of each word: five bits of a second hash choose one of 32."""
    second = F.xxhash64(F.lit(1), key)
    bits = [F.shiftrightunsigned(second, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1), bit) for bit in bits]


def blocked_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter of ``canonical`` keys: ``_slot`` and words ``_w0`` to ``_w7``, one row per block in use."""
    bits = listed.select(_slot(F.col("canonical"), blocks).alias("_slot"), *[m.alias(f"_w{i}") for i, m in enumerate(_masks(F.col("canonical")))])
    return bits.groupBy("_slot").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)])


def blocks_for(keys: int) -> int:
    return max(1, min(MOST_BLOCKS, -(-keys * BITS_PER_KEY // 256)))


def possible(rows: DataFrame, listed: DataFrame, blocks: int) -> DataFrame:
    """``rows`` (with ``_key``) and ``_possible``, false for keys that are surely not listed."""
    words = [F.col(f"_w{i}") for i in range(WORDS)]
    every = F.lit(True)
    for word, mask in zip(words, _masks(F.col("_key"))):
        every = every & (word.bitwiseAND(mask) != 0)
    # At most MOST_BLOCKS rows of 36 bytes.
    held = F.broadcast(blocked_filter(listed, blocks))
    met = rows.withColumn("_slot", _slot(F.col("_key"), blocks)).join(held, "_slot", "left")
    return met.withColumn("_possible", F.coalesce(every & F.col("_key").isNotNull(), F.lit(False))).drop("_slot", *[f"_w{i}" for i in range(WORDS)])


def judged(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``listed``; ``listed`` rows have ``canonical``.

    The list is written once: its size sets the filter's, and the join reads it from files, so that Spark
    can cut a URL that very many pages share. Pages whose key misses the filter take no part in the exchange.
    """
    own = staged(listed.filter(F.col("canonical").isNotNull()).select("canonical").distinct(), "listed-urls")
    packed = pages.select(F.struct(*pages.columns).alias("_row"), F.col("url"), canonical(F.col("url")).alias("_key"))
    probed = possible(packed, own, blocks_for(own.count()))
    keys = own.select(F.col("canonical").alias("_key"), F.lit(True).alias("_listed"))
    hits = probed.filter("_possible").join(keys, "_key", "left")
    rest = probed.filter("NOT _possible").withColumn("_listed", F.lit(False))
    decided = hits.unionByName(rest)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    found = decided.select("_row", F.coalesce("_listed", F.lit(False)).alias("_listed"), host.alias("_host"), path.alias("_path"))
    rule, verdict = ruled(F.col("_host"), F.col("_path"), rules)
    added = {
        "host": F.col("_host"),
        "path": F.col("_path"),
        "rule": rule,
        "verdict": F.coalesce(verdict, F.when(F.col("_listed"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))),
        "listed": F.col("_listed"),
    }
    return found.select(
        *[F.col("_row").getField(c).alias(c) for c in pages.columns if c not in added], *[v.alias(c) for c, v in added.items()]
    )
