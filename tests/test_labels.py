"""Labels, codes, splits, plans and progress on small frames."""

from __future__ import annotations

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sheafwork.operators import install, labels, layout, progress, split
from sheafwork.operators.catalogue import candidate_lists, only_country
from sheafwork.operators.evidence import id_evidence
from sheafwork.operators.quality import paired, with_psnr


def star(spark):
    annotations = spark.createDataFrame([(1, 10, 100, 7), (2, 11, 100, 7), (3, 99, 100, 7), (4, 10, 101, 8)], "id bigint, image_id bigint, category_id bigint, institution_id bigint")
    images = spark.createDataFrame([(10, "images/a.jpg"), (11, "images/b.jpg"), (11, "images/b.jpg")], "image_id bigint, file_name string")
    categories = spark.createDataFrame([(100, "F", "Genus one", "Genus", "one"), (101, "F", "Single", "Single", None)], "category_id bigint, family string, name string, genus string, species string")
    institutions = spark.createDataFrame([(7, "I7"), (8, "I8")], "institution_id bigint, collection_code string")
    return annotations, images, categories, institutions


def test_join_2022_drops_orphans_and_ignores_repeated_keys(spark):
    got = rows(labels.label_join_2022(*star(spark)).select("id", "filename", "species"))
    assert got == [(1, "images/a.jpg", "one"), (2, "images/b.jpg", "one"), (4, "images/a.jpg", None)]


def test_join_2021_uses_the_own_id_and_words_of_the_name(spark):
    annotations, _, categories, institutions = star(spark)
    images = spark.createDataFrame([(1, "images/x/images/1.jpg"), (4, "images/4.jpg")], "id bigint, file_name string")
    named = institutions.withColumnRenamed("collection_code", "institution_name")
    got = rows(labels.label_join_2021(annotations, images, categories, named))
    assert got == [(1, 1, "x/1.jpg", "one", "Genus", "F", "I7"), (4, 4, "4.jpg", None, "Single", "F", "I8")]


def test_violations_count_rows_per_dimension(spark):
    annotations, images, _, institutions = star(spark)
    dims = {"images": ("image_id", images), "institutions": ("institution_id", institutions)}
    assert rows(labels.key_violations(annotations, dims)) == [("images", 1), ("institutions", 0)]


def test_last_position_wins(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (1, 7, "c"), (2, 1, None)], "key int, position int, value string")
    assert rows(labels.last_wins(df, "key", ["position"])) == [(1, "b"), (2, None)]


def test_codes_are_dense_and_follow_code_points(spark):
    names = ["b", "a", "Z", "é", "a", None]
    df = spark.createDataFrame([(n,) for n in names], "scientific_name string")
    got = sorted(labels.label_codes(df).collect(), key=lambda r: r["code"])
    assert [r["scientific_name"] for r in got] == ["Z", "a", "b", "é"]
    assert [r["code"] for r in got] == [0, 1, 2, 3]


@pytest.mark.parametrize("n", [1, 4, 5, 101, 3000])
def test_split_has_the_exact_size_and_repeats(spark, n):
    df = spark.range(n)
    first = {r["id"]: r["split"] for r in split.with_split(df).collect()}
    again = {r["id"]: r["split"] for r in split.with_split(df.repartition(7)).collect()}
    assert first == again
    assert len(first) == n
    assert sum(s == "val" for s in first.values()) == math.ceil(0.2 * n)


def test_text_keys_without_partner_are_counted(spark):
    facts = spark.createDataFrame([("00000__001",), ("00000__002",), (None,)], "image_id string")
    images = spark.createDataFrame([("00000__001",)], "image_id string")
    found = labels.key_violations(facts, {"images": ("image_id", images)}).collect()
    assert [tuple(r) for r in found] == [("images", 2)]


def test_split_looks_into_prefixes_that_hold_many_rows(spark, monkeypatch):
    whole = sorted(r["id"] for r in split.with_split(spark.range(3000)).filter("split = 'val'").collect())
    monkeypatch.setattr(split, "_DIGITS", 1)
    monkeypatch.setattr(split, "_RANKED", 2)
    assert whole == sorted(r["id"] for r in split.with_split(spark.range(3000)).filter("split = 'val'").collect())


@pytest.mark.parametrize("groups", [[50], [30, 1, 1, 18], [7] * 20, [1, 999]])
def test_split_is_exact_where_rows_share_an_id(spark, groups):
    data = [(g, k, None if k % 3 else "x") for g, n in enumerate(groups) for k in range(n)]
    df = spark.createDataFrame(data, "id int, k int, note string")
    first = split.with_split(df)
    assert first.filter("split = 'val'").count() == math.ceil(0.2 * len(data)) and first.count() == len(data)
    again = split.with_split(df.repartition(5))
    assert sorted(map(repr, first.collect())) == sorted(map(repr, again.collect()))
    same = split.with_split(df.select("id"))
    assert same.filter("split = 'val'").count() == math.ceil(0.2 * len(data))


def test_split_of_no_rows_and_of_null_ids(spark):
    assert split.with_split(spark.range(0)).count() == 0
    rows = spark.createDataFrame([(None,), (None,)], "id bigint")
    assert {r["split"] for r in split.with_split(rows).collect()} == {"train"}


def test_split_plan_shuffles_no_rows(spark):
    plan = split.with_split(spark.range(100))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.split("scalar-subquery")[0]


def catalogue(spark):
    data = [(1, 7, "u1"), (2, 7, None), (3, 8, "u3"), (4, None, "u4"), (5, 9, "u5")]
    return spark.createDataFrame(data, "row_id bigint, gbif_id bigint, identifier string").withColumn("country_code", F.lit("NA"))


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def test_lists_keep_missing_links_and_order(spark):
    got = {r["gbif_id"]: (r["n_urls"], r["urls"]) for r in candidate_lists(catalogue(spark)).collect()}
    assert got == {7: (2, ["u1", None]), 8: (1, ["u3"]), 9: (1, ["u5"])}


def test_country_named_na_is_a_country(spark):
    assert only_country(catalogue(spark), "NA").count() == 5
    assert only_country(catalogue(spark).drop("country_code"), "XX").count() == 5
    assert only_country(catalogue(spark), None).count() == 5


def test_progress_counts_double_listed_ids_twice(spark):
    done, failed = lines(spark, " 7 ", "8", "", "\t", "007"), lines(spark, "7", "5")
    states = progress.state_counts(id_evidence(catalogue(spark), done, failed))
    row = progress.progress(states).first()
    assert (row["total_ids"], row["processed"], row["failed"], row["attempted"], row["remaining"]) == (3, 2, 1, 3, 1)
    stats = progress.catalogue_stats(states).first()
    assert (stats["total_rows"], stats["unique_ids"]) == (5, 3)
    assert rows(progress.urls_by_state(states)) == [("failed", 2), ("processed", 3), ("remaining", 1), ("total", 6)]
    assert rows(progress.extra_ids(id_evidence(catalogue(spark), done, failed))) == [("failed", "5"), ("processed", "007")]


def test_empty_catalogue_gives_nulls_not_errors(spark):
    empty = catalogue(spark).limit(0)
    states = progress.state_counts(id_evidence(empty, lines(spark, "1"), lines(spark)))
    row = progress.progress(states).first()
    assert row["total_ids"] == 0 and row["pct_processed"] is None
    assert progress.report_lines(states, "2024-01-01 00:00:00", "/s", "/o").count() > 50


def test_plan_asks_lists_before_duplicates_and_sizes(spark):
    data = [(i, i, "u") for i in range(1, 8)]
    cat = spark.createDataFrame(data, "row_id bigint, gbif_id bigint, identifier string")
    prior = spark.createDataFrame([(1,), (2,), (3,), (4,), (99,)], "gbif_id bigint")
    path = lambda i: f"store/{i}/000/{i}.jpg"
    stored = spark.createDataFrame(
        [(path(3), 5), (path(5), 10485), (path(6), 10486), ("store/elsewhere/7.jpg", 99999)], "path string, length bigint"
    )
    plan = install.planned(id_evidence(cat, lines(spark, "1"), lines(spark, "2"), [prior], stored))
    got = {r["id"]: r["action"] for r in plan.collect()}
    assert got == {"1": "done", "2": "failed", "3": "duplicate", "4": "duplicate", "5": "refetch", "6": "record_done", "7": "fetch"}
    assert rows(install.duplicate_removals(plan)) == [("3", path(3))]


def test_reorganise_plan_reports_collisions(spark):
    paths = ["f/1234567.jpg", "f/c/1234567.jpg", "f/IMG_1.jpg", "f/12.PNG", "f/13.Jpg"]
    files = spark.createDataFrame([(p, 1) for p in paths], "path string, length bigint")
    got = {r["path"]: (r["target"], r["action"], r["collision"]) for r in layout.reorganise_plan(files).collect()}
    assert got == {
        "f/1234567.jpg": ("store/123/456/1234567.jpg", "move", True),
        "f/c/1234567.jpg": ("store/123/456/1234567.jpg", "move", True),
        "f/IMG_1.jpg": (None, "skip", False),
        "f/12.PNG": ("store/12/000/12.PNG", "move", False),
    }


def test_psnr(spark):
    originals = spark.createDataFrame([("a.png", [0, 10]), ("b.png", [1, 2])], "name string, px array<int>")
    copies = spark.createDataFrame([("recompressed_a.png", [0, 20]), ("recompressed_b.png", [1, 2])], "name string, px array<int>")
    got = {r["name"]: (r["mse"], r["psnr"], r["identical"]) for r in with_psnr(paired(originals, copies)).collect()}
    assert got["a.png"][0] == 50.0 and abs(got["a.png"][1] - 10 * math.log10(255**2 / 50)) < 1e-9 and not got["a.png"][2]
    assert got["b.png"] == (0.0, None, True)
