"""Mixing, sharding and the pipeline; queries against their SQL."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from check import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from sheafwork.llm import ORACLES, QUERIES, mixing, sharding

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [
    (1, "a b c", "en", "x", 5), (1, "a b c", "en", "x", 5), (2, None, "en", "x", 0), (3, "", None, None, 0),
    (None, "d e", "en", None, 3), (4, "f " * 9000, "en", "z", 9), (5, None, "en", "empty", None),
]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert not compare(spark, connect(SF_DIR), name, SF_DIR)


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def targets_by_rounds(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(weight[n] for n in free)
        full = {n for n in free if level * weight[n] >= limit * sizes[n]}
        if not full:
            return target | {n: level * weight[n] for n in free}
        for n in full:
            target[n] = limit * sizes[n]
            left -= target[n]
        free -= full
    return target


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 0, "d": 7, "e": 400, None: 90, "B": 3}
    rows = spark.createDataFrame([(n, s) for n, s in sizes.items()], "source string, size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    expected = targets_by_rounds(sizes)
    assert all(got[n] == pytest.approx(expected[n]) for n in sizes)


def test_mixture_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, DOCS).withColumn("size", F.lit("own")).withColumn("copies", F.lit(-1))
    plan = mixing.with_copies(df)
    rows = plan.collect()
    assert len(rows) == len(ODD)
    assert all(0 <= r["size"] * r["copies"] <= 2 * r["size"] for r in rows)
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns
    got = Counter((r["doc_id"], r["text"], r["size"]) for r in mixed.collect())
    want = Counter()
    for r in rows:
        want[(r["doc_id"], r["text"], "own")] += r["copies"]
    assert got == +want
    assert mixing.mixed(df.limit(0)).count() == 0 and mixing.with_copies(df.filter("doc_id = 5")).first()["target"] == 0


def test_taken_words_come_near_the_targets(spark):
    rows = QUERIES["op8_source_mixing"](spark, SF_DIR.replace("0.001", "0.1")).collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for source, words in target.items():
        assert taken[source] == pytest.approx(words, rel=0.15)
    again = QUERIES["op8_source_mixing"](spark, SF_DIR.replace("0.001", "0.1"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards(spark, many_chunks, shards):
    df = spark.createDataFrame([(i, f"t{i % 7}", "en", f"s{i % 11 % 4}", 1) for i in range(200)] + ODD, DOCS)
    rows = sharding.sharded(df.withColumn("shard", F.lit("own")), shards).collect()
    assert len(rows) == 207
    slots, mixture = defaultdict(list), defaultdict(Counter)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        mixture[r["shard"]][r["source"]] += 1
    sizes = [len(s) for s in slots.values()]
    assert len(slots) == shards and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    whole = Counter(r["source"] for r in rows)
    for own in mixture.values():
        assert all(abs(own[s] - whole[s] / shards) <= 2 for s in whole)


def test_shards_of_few_rows(spark):
    df = spark.createDataFrame(ODD, DOCS)
    rows = sharding.sharded(df).collect()
    assert sorted(r["size"] for r in rows) == sorted(len((r[1] or "").encode()) + 1 for r in ODD)
    assert all(r["slot"] == 0 for r in rows) and len({r["shard"] for r in rows}) == len(ODD)
    assert sharding.sharded(df.limit(0)).count() == 0


def test_pipeline_stages_on_odd_rows(spark):
    text = "The quick brown fox and the lazy dog were in the garden of the old house and "
    odd = ODD + [(10, text * 3, "en", "x", 1), (11, text * 3, "en", "x", 1), (12, text * 3 + "more", "en", "y", None)]
    odd += [(13, "123 !", "en", "x", 1), (14, "Der schnelle braune Fuchs und der faule Hund " * 3, "de", "y", 1)]
    docs = spark.createDataFrame(odd, DOCS).withColumn("rejected", F.lit("own")).withColumn("component_id", F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF_DIR)
        assert empty.count() == 0, name
        out = stage(spark, docs, SF_DIR)
        if name != "tokens":
            assert out.columns == docs.columns, name
        ids = [r["doc_id"] for r in out.select("doc_id").collect()]
        if name == "language":
            assert not {2, 3, 5, 13} & set(ids) and {10, 14} <= set(ids)
        if name == "near_copies":
            assert 10 in ids and not {11, 12} & set(ids) and ids.count(1) == 1 and None in ids and {2, 3, 5} <= set(ids)


def test_pipeline_against_brute_force(spark):
    """Every decision of the whole run, replayed stage by stage without Spark where it can be."""
    from test_copies import brute_components

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language"](spark, docs, SF_DIR)
    assert known.count() >= 0.98 * docs.count()
    rows = [(r["doc_id"], r["text"]) for r in known.collect()]
    lead = {c for _, c in brute_components(rows, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.PERCENT).values()}
    kept = stages["near_copies"](spark, known, SF_DIR)
    assert {r["doc_id"] for r in kept.collect()} == lead
    cut = stages["repeated_passages"](spark, kept, SF_DIR)
    mixed = stages["mixture"](spark, cut, SF_DIR)
    times = {r["doc_id"]: r["copies"] for r in mixing.with_copies(cut).collect()}
    assert Counter(r["doc_id"] for r in mixed.collect()) == +Counter(times)
    out = corpus_pipeline.run(spark, SF_DIR)
    assert Counter(r["doc_id"] for r in out.collect()) == +Counter(times)


OWN_NAMES = ("_lead", "_doc", "_mark", "_spans", "_row", "lead", "mark", "row", "rows", "spans", "c1", "score", "lang_pred")


def test_pipeline_stages_with_clashing_names(spark):
    """Columns of any name pass through every stage with their values."""
    text = "The quick brown fox and the lazy dog were in the garden of the old house by the sea and "
    rows = [(i, text * 2 + f"then {i} of them came home again", "en", "x", 1) for i in (20, 21)]
    rows += [(22 + i, " ".join(f"word{i}{k}" for k in range(40)) + " and " + text * 4, "en", "x", 1) for i in range(2)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({name: F.concat(F.lit(name), "doc_id") for name in OWN_NAMES})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert all(r[c] == f"{c}{r['doc_id']}" for c in OWN_NAMES), name


def test_near_copies_of_an_id_with_two_texts(spark):
    texts = [" ".join(f"{w}{k}" for k in range(30)) for w in "ab"]
    rows = [(1, texts[0], "en", "x", 1), (1, texts[1], "en", "x", 2), (2, texts[1] + " more", "en", "x", 3), (3, texts[0], "en", "y", 4)]
    stage = dict(corpus_pipeline.STAGES)["near_copies"]
    kept = [sorted(map(tuple, stage(spark, spark.createDataFrame(own, DOCS), SF_DIR).collect())) for own in (rows, rows[::-1])]
    assert kept[0] == kept[1] and [r[0] for r in kept[0]] == [1]
