"""Ranked search, hard negatives and URL filters: against brute force and on odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafwork.llm import hard_negatives, lexical, url_filter

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_ranking(docs, items, k):
    counted = [(d, Counter(terms(t))) for d, t in docs if d is not None]
    counted = [(d, c) for d, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for d, c in counted:
            norm = 50 + (50 * sum(c.values()) * n) // total
            weight = lambda t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * ((10**9 * c[t]) // (1000 * c[t] + 20 * norm)) for t in wanted if t in c)
            if score > 0:
                scores.append((-score, d))
        out += [(item, i, d, -s) for i, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def corpus(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Ünï", "日本"]
    common = ["the", "AND", "of"]
    text = lambda m: " ".join(rng.choice(common) if rng.random() < 0.4 else words[int(len(words) * rng.random() ** 2)] for _ in range(m))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(30)]
    return docs, [(i, text(rng.randrange(1, 12))) for i in range(25)]


@pytest.mark.parametrize("block,items_each", [(lexical.BLOCK, lexical.GROUP_ITEMS), (32, 7)])
def test_ranking_agrees_with_brute_force(spark, monkeypatch, block, items_each):
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "GROUP_ITEMS", items_each)
    monkeypatch.setattr(lexical, "OWNERS", (0.01, 0.05, 0.2, 1.0))
    docs, items = corpus(3, 500)
    found = lexical.ranked(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame(items, "item_id bigint, text string"),
        k=10,
    )
    assert sorted(map(tuple, found.collect())) == brute_ranking(docs, items, 10)


def test_later_owners_begin_no_hopeless_documents():
    """With a threshold beyond what is left, frequent terms only add to documents that earlier terms began."""
    ids = np.arange(3, dtype=np.int64)
    asked = np.array([[5, 1, 10, 400_000, 0], [9, 1, 1, 400_000, 1]], np.int64)
    bundle = lexical.Bundle({"ids": ids.tobytes(), "terms": asked.tobytes(), "offsets": None, "cells": None})
    plane = lambda *v: lexical.planes(np.array(v))
    rare = {"term": 5, "docs": plane(1), "tf": plane(1), "length": plane(10)}
    frequent = {"term": 9, "docs": plane(0, 1, 2), "tf": plane(1, 1, 1), "length": plane(10, 10, 10)}
    bundle.advance(0, [rare], np.zeros(1), 3, 30)
    bundle.advance(1, [frequent], np.array([1_000_000.0]), 3, 30)
    assert (bundle.scores[0] > 0).tolist() == [False, True, False]
    assert bundle.scores[0, 1] == 11 * (10**9 // 3000)


def test_ranking_of_odd_rows(spark):
    docs = [
        (1, "Apple, pie!"), (1, "apple PIE"), (2, None), (3, ""), (4, " .,; "), (None, "apple"),
        (5, "apple " * 20_000), (6, "Äpfel apple"), (7, "zebra"), (8, "äpfel"), (9, "x"), (10, "y"),
    ]
    items = [(1, "APPLE"), (1, "pie pie"), (2, None), (3, ""), (None, "apple"), (4, "unknown"), (5, "Äpfel")]
    own = spark.createDataFrame([(d, t, 0, 0) for d, t in docs], "doc_id bigint, text string, term int, score int")
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    assert sorted(map(tuple, lexical.ranked(own, asked).collect())) == brute_ranking(docs, items, lexical.K)
    assert lexical.ranked(own.limit(0), asked).count() == 0
    assert lexical.ranked(own, asked.limit(0)).count() == 0


def brute_negatives(rows, is_anchor, positives=5, negatives=10):
    usable = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, label, [math.floor(256 * np.float32(x).astype(float)) for x in vector]))
    anchors = {}
    for vec_id, label, v in usable:
        if is_anchor(vec_id):
            anchors[vec_id] = min(anchors.get(vec_id, (label, v)), (label, v))
    out = []
    for anchor, (label, v) in anchors.items():
        scored = [(-sum(a * b for a, b in zip(v, w)), i, own) for i, own, w in usable if i != anchor and len(w) == len(v)]
        mine = sorted((s, i) for s, i, own in scored if own == label)[:positives]
        for score, positive in mine:
            inside = sorted((s, i) for s, i, own in scored if own != label and 30 * -score <= 100 * -s <= 90 * -score)
            out += [(anchor, positive, rank, i, -score, -s) for rank, (s, i) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def vectors(seed, n, dims=24):
    rng = np.random.default_rng(seed)
    center = rng.normal(0, 0.3, (4, dims))
    rows = [(i, (center[i % 4] + rng.normal(0, 0.25, dims)).astype(np.float32).tolist(), int(rng.integers(0, 5))) for i in range(n)]
    return rows + [(n + i, rows[3][1], rows[3][2]) for i in range(20)]


@pytest.mark.parametrize("block,pack", [(hard_negatives.BLOCK, hard_negatives.PACK), (32, 3)])
def test_negatives_agree_with_brute_force(spark, monkeypatch, block, pack):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "PACK", pack)
    rows = vectors(1, 400)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    found = hard_negatives.mined(df, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_scan_keeps_what_counts_and_drops_the_rest():
    rng = np.random.default_rng(4)
    data = rng.integers(-60, 60, (500, 32))
    data[::7] = data[0] + rng.integers(-3, 3, data[::7].shape)
    labels = (np.arange(500) % 3).astype(np.int64)
    block = hard_negatives.VerticalBlock(
        {"ids": np.arange(500).tobytes(), "labels": labels.tobytes(), "dim": 32, "columns": hard_negatives.narrow(data.T)}
    )
    seen = []

    def still_needed(least, most):
        exact = data @ data[0]
        threshold = hard_negatives._kth(least, 5)
        seen.append(len(least))
        return most >= threshold

    rows, scores = block.scan(data[0], np.ones(500, bool), still_needed)
    exact = data @ data[0]
    assert (scores == exact[rows]).all() and set(np.argsort(-exact)[:5]) <= set(rows)
    assert seen[0] == 500 and seen[-1] < 250


def test_negatives_of_odd_rows(spark):
    rows = [
        (0, [1.0, 0.5], 1), (0, [0.5, 0.5], 1), (1, [1.0, 0.4], 1), (2, [0.5, 0.1], 2), (2, [0.5, 0.1], 2), (3, [0.4, 0.4], None),
        (4, None, 2), (5, [None, 1.0], 2), (6, [float("nan"), 1.0], 2), (7, [float("inf"), 1.0], 2), (8, [], 2), (None, [0.5, 0.1], 2),
        (10, [-1.0, 0.0], 3), (11, [1.0, 0.0], 3), (20, [0.5, 0.1, 0.1], 2), (21, [0.5, 0.2, 0.1], 2), (22, [0.2, 0.1, 0.1], 4),
        (30, [0.7, 0.0], 9), (31, [-128.0, 127.0], 9),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id bigint, embedding array<float>, label int, block int")
    found = hard_negatives.mined(df, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, lambda i: i % 10 == 0)
    assert hard_negatives.mined(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mined(df, F.lit(False)).count() == 0


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :]).group()


def brute_rule(url):
    host, path = split_url(url)
    fits = [r for r in url_filter.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0]) + len(r[1]), default=None)


URLS = [
    None, "", "example.com/x", "http://", "http:///x", "http://a.example.net", "http://a.example.net/", "HTTP://A.Example.NET/EN/x",
    "http://b.example.net/en/x", "http://xexample.net/en/", "http://example.com/de/", "http://m.example.com/de", "http://k.org/fr/?a=b",
    "http://net/", "http://spam.example.com/a", "https://www.spam.example.com:443/a/?utm_x=1#f", "http://spam.example.com/a?b=2&a=1&ref=z",
    "http://spam.example.com/a?a=1&b=2", "http://spam.example.com/A", "http://ok.example.com/a", "http://ÄSpam.example.com/a",
    "http://x.org/p?u=http://spam.example.com/a", "http://spam.example.org/fr/1", "http://u@h.example.net:8080/en/", "a://b://c/d",
]


@pytest.mark.parametrize("most", [url_filter.MOST_BLOCKS, 1])
def test_urls_are_judged_as_by_hand(spark, monkeypatch, most):
    """The answers don't depend on the filter's size: one block for all is a filter that lets much pass."""
    monkeypatch.setattr(url_filter, "MOST_BLOCKS", most)
    many = URLS + [f"http://spam.example.com/{i}" for i in range(300)] + [f"http://fine.example.com/{i}" for i in range(300)]
    pages = spark.createDataFrame([(i, u, "own", 1) for i, u in enumerate(many * 2)], "page_id bigint, url string, verdict string, _key int")
    found = url_filter.judged(pages, url_filter.listed_by_words(pages))
    assert found.columns == ["page_id", "url", "_key", "host", "path", "rule", "verdict", "listed"]
    rows = found.collect()
    assert len(rows) == len(pages.collect())
    for r in rows:
        host, path = split_url(r["url"])
        rule = brute_rule(r["url"])
        listed = bool(set(url_filter.BLOCKED_WORDS) & set(re.split("[.-]", host)))
        expected = rule[2] if rule else url_filter.BLOCK if listed else url_filter.ALLOW
        assert (r["host"], r["path"], r["rule"], r["verdict"], r["listed"]) == (host, path, rule and rule[0] + rule[1], expected, listed), r


def test_canonical_urls(spark):
    told = spark.createDataFrame([(u,) for u in URLS], "url string")
    key = dict(map(tuple, told.select("url", url_filter.canonical(F.col("url"))).collect()))
    assert key["http://spam.example.com/a"] == key["https://www.spam.example.com:443/a/?utm_x=1#f"] == "spam.example.com/a"
    assert key["http://spam.example.com/a?b=2&a=1&ref=z"] == key["http://spam.example.com/a?a=1&b=2"] == "spam.example.com/a?a=1&b=2"
    assert key["http://spam.example.com/A"] == "spam.example.com/A" and key[None] is None and key["http://"] is None


def test_list_from_elsewhere(spark):
    pages = spark.createDataFrame([(1, "http://a.example.com/x?utm_s=1"), (2, "http://a.example.com/y")], "page_id bigint, url string")
    listed = spark.createDataFrame([("a.example.com/x",), ("a.example.com/x",), (None,)], "canonical string")
    judged = url_filter.judged(pages, listed)
    assert dict(judged.select("page_id", "verdict").collect()) == {1: "block", 2: "allow"}
    assert {r["verdict"] for r in url_filter.judged(pages, listed.limit(0)).collect()} == {"allow"}
    assert url_filter.judged(pages.limit(0), listed).count() == 0


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(4000).select(F.concat(F.lit("host.example/"), "id").alias("canonical"))
    listed, other = keys.filter(F.col("canonical").endswith("0")), keys.filter(~F.col("canonical").endswith("0"))
    blocks = url_filter.blocks_for(400)
    passed = lambda df: url_filter.possible(df.withColumnRenamed("canonical", "_key"), listed, blocks).filter("_possible").count()
    assert passed(listed) == 400 and passed(other) < 0.02 * 3600


def test_filter_uses_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.example.com/x")], "page_id bigint, url string")
    plan = url_filter.judged(pages, url_filter.listed_by_words(pages))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
