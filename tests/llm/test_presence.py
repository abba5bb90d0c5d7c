"""Rows a list names meet it in an exchange; all others stay where they are."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sheafwork.llm import ngram_join, presence, suffix_dedup, url_filter


@pytest.fixture
def no_broadcasts(spark):
    """Joins as over tables that are too large to be broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.unset(name)


def texts(n: int) -> list[str]:
    draw = random.Random(5)
    return [" ".join(f"w{draw.randrange(10**6)}" for _ in range(60)) for _ in range(n)]


def in_order(ids: list[int]) -> bool:
    return ids == sorted(ids)


@pytest.mark.parametrize("blocks", [1, url_filter.MOST_BLOCKS])
def test_no_row_of_the_list_is_missed(spark, monkeypatch, blocks):
    monkeypatch.setattr(url_filter, "MOST_BLOCKS", blocks)
    rows = spark.range(3000).select(F.when(F.col("id") < 2990, F.col("id")).alias("_key"), F.col("id").alias("_slot"))
    keys = spark.range(0, 3000, 7).toDF("k")
    doubtful, sure = presence.told_apart(rows, F.col("_key"), keys)
    some, rest = [r["_key"] for r in doubtful.collect()], [r["_key"] for r in sure.collect()]
    assert {*range(0, 2990, 7)} <= {*some} and None not in some and rest.count(None) == 10
    assert len(some) + len(rest) == 3000 and {*some, *rest} == {None, *range(2990)}
    # A full filter lets all pass; one of a fitting size hardly any but those of the list.
    assert blocks == 1 or len(some) < 500


def test_texts_without_repeats_are_not_exchanged(no_broadcasts):
    spark, own = no_broadcasts, texts(200)
    own[199] = own[0]
    docs = spark.createDataFrame(list(enumerate(own)), "doc_id bigint, text string")
    spans = docs.filter("doc_id = 199").select(
        "doc_id", F.xxhash64("text").alias("mark"), F.expr("array(struct(0 AS start, 50 AS end, 0L AS first_doc_id)) AS spans")
    )
    left = [tuple(r) for r in suffix_dedup.without_spans(docs, spans).collect()]
    assert sorted(left) == [*enumerate(own[:199]), (199, " ".join(own[199].split()[50:]))]
    assert in_order([i for i, _ in left if i != 199])


def test_documents_without_copies_are_not_exchanged(no_broadcasts):
    spark, own = no_broadcasts, texts(200)
    own[150] = own[7]
    rows = [*enumerate(own), (20, own[20]), (20, own[20]), (None, own[7])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    kept = [tuple(r) for r in corpus_pipeline.near_copies(spark, docs, "").collect()]
    assert sorted(kept, key=repr) == sorted([*((i, t) for i, t in enumerate(own) if i != 150), (None, own[7])], key=repr)
    assert in_order([i for i, _ in kept if i not in (7, 20, None)])


def test_near_copies_are_searched_among_documents_that_may_have_some(spark, monkeypatch):
    own, searched, candidate_edges = texts(200), [], ngram_join.candidate_edges
    own[150] = f"{own[7]} more"
    docs = spark.createDataFrame(list(enumerate(own)), "doc_id bigint, text string")
    monkeypatch.setattr(ngram_join, "candidate_edges", lambda docs, *given: searched.append(docs) or candidate_edges(docs, *given))
    kept = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert kept == {*range(200)} - {150}
    ids = {r["doc_id"] for r in searched[0].collect()}
    assert {7, 150} <= ids and len(ids) < 30
