"""Repeated passages by sorted suffixes: against brute force and on odd rows."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafwork.llm import suffix_array

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)


def brute_windows(rows, n):
    """Words of each document that lie in a run of ``n`` words that begins before it, too (id, then position)."""
    seen, found = set(), defaultdict(set)
    for i, text in sorted(rows):
        own = text.split()
        for k in range(len(own) - n + 1):
            window = tuple(own[k : k + n])
            if window in seen:
                found[i].update(range(k, k + n))
            seen.add(window)
    return found


def partial_copies(seed, groups, shares):
    """Documents of a passage each: some hold its beginning, its end or its middle, some all of it."""
    rng, rows = random.Random(seed), []
    word = lambda: f"{rng.randrange(10**9):x}"
    for _ in range(groups):
        passage = [word() for _ in range(rng.choice([50, 55, 60, 90, 140]))]
        for _ in range(shares):
            n = rng.choice([35, 45, len(passage) - 1, len(passage), len(passage)])
            at = rng.choice([0, len(passage) - n, rng.randrange(len(passage) - n + 1)])
            own = [word() for _ in range(rng.randrange(60))] + passage[at : at + n] + [word() for _ in range(rng.randrange(60))]
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("rows_of_a_part", [200_000, 40])
def test_passages_are_found_where_earlier_documents_hold_parts_of_them(spark, monkeypatch, rows_of_a_part):
    """No word of a repeated run of 50 is missed, and none is reported that lies in no repeated run of 30."""
    monkeypatch.setattr(suffix_array, "ROWS", rows_of_a_part)
    rows = partial_copies(11, 60, 8) + [(10_000 + i, t) for i, t in partial_copies(12, 1, 300)]
    found = defaultdict(set)
    for r in suffix_array.repeated_spans(table(spark, rows)).collect():
        for s in r["spans"]:
            found[r["doc_id"]].update(range(s["start"], s["end"]))
    whole, loose = brute_windows(rows, suffix_array.LEAST), brute_windows(rows, suffix_array.CORE)
    assert sum(map(len, whole.values())) > 20_000
    assert {i: sorted(v - found[i]) for i, v in whole.items() if v - found[i]} == {}
    assert {i: sorted(v - loose[i]) for i, v in found.items() if v - loose[i]} == {}


@pytest.mark.parametrize("n", [50, 55, 60])
def test_last_of_three_copies_is_found_when_the_first_is_cut_short(spark, n):
    rng, rows = random.Random(n), []
    word = lambda: f"{rng.randrange(10**9):x}"
    for k in range(100):
        passage = [word() for _ in range(n)]
        for own in (passage[:45], passage, passage):
            rows.append((len(rows), " ".join([word() for _ in range(30)] + own + [word() for _ in range(30)])))
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in suffix_array.repeated_spans(table(spark, rows)).collect()}
    assert spans == {3 * k + 2: [(30, 30 + n)] for k in range(100)}


def test_runs_of_sorted_suffixes_agree_with_brute_force():
    rng = np.random.default_rng(2)
    rows = sorted((int(c), [int(x) for x in rng.integers(1, 3, rng.integers(0, suffix_array.REACH + 1))]) for c in rng.integers(0, 6, 400))
    rank = rng.integers(0, 300, 400).astype(np.int32)
    held = np.array([len(w) for _, w in rows])
    beside = np.array([w + [0] * (suffix_array.REACH - len(w)) for _, w in rows], np.uint32)
    least, more = suffix_array.run_minima(np.array([c for c, _ in rows]), beside, held, rank)
    for i, (core, own) in enumerate(rows):
        runs = [[r for (c, w), r in zip(rows, rank) if c == core and w[:k] == own[:k]] for k in range(len(own) + 1)]
        assert least[i, : len(own) + 1].tolist() == [min(r) for r in runs]
        assert more[i] == max([k for k, r in enumerate(runs) if min(r) < rank[i]], default=-1)


def test_suffixes_of_odd_rows(spark):
    long = " ".join(f"q{k}" for k in range(30_000))
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [
        (1, None), (2, ""), (3, passage), (3, passage), (None, passage), (4, f"x {passage} y"), (5, long), (6, f"a {long}"),
        (7, f"{passage} z {passage}"), (8, "r " * 300),
    ]
    df = table(spark, rows).withColumn("mark", F.lit(1)).withColumn("spans", F.lit("s")).withColumn("_spans2", F.lit(0))
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in suffix_array.repeated_spans(df).collect()}
    assert spans[4] == [(1, 61)] and spans[6] == [(1, 30_001)] and spans[7] == [(0, 60), (61, 121)]
    assert set(spans) <= {4, 6, 7, 8}
    kept = suffix_array.without_repeats(df)
    texts = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert texts[(3, passage)] == 2 and texts[(None, passage)] == 1 and texts[(1, None)] == 1 and texts[(2, "")] == 1
    assert texts[(4, "x y")] == 1 and texts[(5, long)] == 1 and kept.columns == df.columns
    assert suffix_array.without_repeats(df.limit(0)).count() == 0


def test_cut_texts_keep_first_copies_and_clean_texts(spark):
    rows = partial_copies(5, 20, 6)
    out = {r["doc_id"]: r["text"] for r in suffix_array.without_repeats(table(spark, rows)).collect()}
    spans = {r["doc_id"]: r["spans"] for r in suffix_array.repeated_spans(table(spark, rows)).collect()}
    assert len(spans) > 20
    for i, text in rows:
        own = text.split()
        for s in reversed(spans.get(i, [])):
            del own[s["start"] : s["end"]]
        assert out.get(i, "") == (text if i not in spans else " ".join(own)) or out[i].split() == own
