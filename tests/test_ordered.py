"""Ordered work: chunked results against plain Python, with one key owning most rows."""

from __future__ import annotations

import hashlib
import random

import pytest

from sheafwork.operators import ordered
from sheafwork.operators.candidates import ordered_candidates
from sheafwork.operators.labels import label_join_2022
from sheafwork.operators.skew import Heavy, heavy_keys, spread_join
from pyspark.sql import functions as F

SCHEMA = "k string, t bigint, i bigint, e int, v bigint"


def sample(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    return [
        (
            "hot" if rng.random() < 0.6 else f"k{rng.randrange(12):02d}",
            rng.randrange(n // 3),
            i,
            rng.randrange(2),
            rng.randrange(10**15) if rng.random() < 0.1 else None,
        )
        for i in range(n)
    ]


def by_key(data):
    groups = {}
    for row in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.fixture(params=[200, 5000])
def data(request):
    return sample(request.param, request.param)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def chunk_sizes(spark, data):
    return [r["n"] for r in ordered.ordered_chunks(frame(spark, data), ["k", "t", "i"]).groupBy("_chunk").agg(F.count("*").alias("n")).collect()]


def test_a_hot_key_is_cut(many_chunks, data):
    sizes = chunk_sizes(many_chunks, data)
    assert len(sizes) > 4 and max(sizes) < len(data) * 0.4


def test_written_rank_makes_one_copy(many_chunks, data, monkeypatch):
    copies = []
    monkeypatch.setattr(ordered, "staged", lambda df, label, whole=ordered.staged: copies.append(label) or whole(df, label))
    monkeypatch.setattr(ordered, "pinned", lambda df: 1 / 0)
    df = frame(many_chunks, data)
    ranked = ordered.written_rank(df, ["t", "i"], "n")
    got = {r["i"]: r["n"] for r in ranked.collect()}
    in_order = sorted(df.collect(), key=lambda r: (r["t"], r["i"]))
    assert got == {r["i"]: n for n, r in enumerate(in_order, 1)} and copies == ["ranked"]
    assert ordered.written_rank(df.limit(0), ["t", "i"], "n").count() == 0


def test_exact_rank(many_chunks, data):
    got = {r["i"]: r["n"] for r in ordered.exact_rank(frame(many_chunks, data), ["t", "i"], "n").collect()}
    assert got == {row[2]: n for n, row in enumerate(sorted(data, key=lambda r: (r[1], r[2])), 1)}


@pytest.mark.parametrize("batch", [7, 10_000])
def test_chunked_count(many_chunks, data, batch):
    many_chunks.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    got = {r["i"]: r["n"] for r in ordered.chunked_count(frame(many_chunks, data), "k", ["t", "i"], "e", "n").collect()}
    many_chunks.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {}
    for rows in by_key(data).values():
        seen = 0
        for row in rows:
            expected[row[2]] = seen
            seen += row[3]
    assert got == expected


@pytest.mark.parametrize("batch", [7, 10_000])
def test_chunked_last(many_chunks, data, batch):
    many_chunks.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    got = {r["i"]: r["n"] for r in ordered.chunked_last(frame(many_chunks, data), "k", ["t", "i"], "v", "n").collect()}
    many_chunks.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {}
    for rows in by_key(data).values():
        last = None
        for row in rows:
            expected[row[2]] = last
            last = row[4] if row[4] is not None else last
    assert got == expected


def test_ordinary_and_heavy_keys_together(many_chunks, data):
    df = frame(many_chunks, data)
    found = heavy_keys(df, "k")["k"]
    assert [k for k, _ in found.tasks] == ["hot"]
    expected = {}
    for rows in by_key(data).values():
        for n, row in enumerate(rows, 1):
            expected[row[2]] = n
    for heavy in (found, Heavy("k", ()), None):
        ranked = ordered.rank_in_key(df, "k", ["t", "i"], "n", heavy)
        assert {r["i"]: r["n"] for r in ranked.collect()} == expected


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_keeps_every_row(spark, data, how):
    df = frame(spark, data)
    dimension = spark.createDataFrame([("hot", "H"), ("k01", "A"), ("k02", "B")], "k string, name string")
    plain = df.join(dimension, "k", how)
    spread = spread_join(df, dimension, heavy_keys(df, "k")["k"], by=F.col("i"), how=how)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, spread.select(*plain.columns).collect()))


def test_a_pile_of_copies_is_ordered_whole(many_chunks, tmp_path):
    links = [(7, "http://h/same.jpg")] * 900 + [(7, f"http://h/{i}.jpg") for i in range(100)] + [(i, "x") for i in range(100, 150)]
    many_chunks.createDataFrame(links, "gbif_id bigint, candidate_url string").repartition(4).write.parquet(str(tmp_path / "c"))
    got = ordered_candidates(many_chunks.read.parquet(str(tmp_path / "c"))).collect()
    assert sorted(r["pos"] for r in got if r["gbif_id"] == 7) == list(range(1, 1001))
    assert sorted((r["gbif_id"], r["candidate_url"]) for r in got) == sorted(links)
    by_mix = sorted((hashlib.md5(f"{g}|{u}|42".encode()).hexdigest(), u) for g, u in links if g == 7)
    assert [r["candidate_url"] for r in sorted(got, key=lambda r: r["pos"]) if r["gbif_id"] == 7] == [u for _, u in by_mix]


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_hot_keys_are_spread_whatever_spark_estimates(spark, tmp_path, limit):
    """A hot key's rows are found and dealt over tasks whether or not Spark would broadcast the other side."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        star = {"images": [("hot", "a.jpg"), ("k", "b.jpg")], "categories": [(1, "F", "G", "s")], "institutions": [(1, "C")]}
        images = spark.createDataFrame(star["images"], "image_id string, file_name string")
        categories = spark.createDataFrame(star["categories"], "category_id int, family string, genus string, species string")
        institutions = spark.createDataFrame(star["institutions"], "institution_id int, collection_code string")
        facts = [(f"a{i}", "hot" if i % 10 else "k", 1, 1) for i in range(400)]
        annotations = spark.createDataFrame(facts, "id string, image_id string, category_id int, institution_id int")
        heavy = heavy_keys(annotations, "image_id")["image_id"]
        assert dict(heavy.tasks)["hot"] >= 2
        joined = label_join_2022(annotations, images, categories, institutions)
        assert sorted(r["id"] for r in joined.collect()) == sorted(f[0] for f in facts)
        assert "_spread" in joined._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_heavy_key_means_a_plain_join(spark):
    df = spark.range(1000).withColumn("k", F.col("id"))
    assert heavy_keys(df, "k")["k"].tasks == ()


def test_empty_input(many_chunks):
    empty = many_chunks.createDataFrame([], SCHEMA)
    assert ordered.running_count(empty, "k", ["t", "i"], "e", "n").count() == 0
    assert ordered.chunked_count(empty, "k", ["t", "i"], "e", "n").count() == 0
    assert ordered.exact_rank(empty, ["t", "i"], "n").count() == 0


def test_keys_of_a_thousandth_are_spread_when_partitions_are_many(spark):
    rows = spark.range(200_000).select(F.when(F.col("id") < 180, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "10000")
    try:
        found = heavy_keys(rows, "k")["k"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert dict(found.tasks).get("hot", 0) >= 2
