"""Column expressions on literal rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sheafwork.functions import http, ids, store, text, urls


def value(spark, column, **fields):
    row = [tuple(fields.values())]
    schema = ", ".join(f"{n} {'bigint' if isinstance(v, int) else 'string'}" for n, v in fields.items())
    return spark.createDataFrame(row, schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("url", "host"),
    [
        ("http://user:pw@H.example.org:8080/x", "user"),
        ("https://my_host.org/a b.jpg", "my_host.org"),
        ("//h.org/x", "h.org"),
        ("h.org/x", ""),
        ("http://[::1]:80/x", "["),
        ("http://Host.ORG?q=1", "Host.ORG"),
    ],
)
def test_host(spark, url, host):
    assert value(spark, urls.host_of(F.col("u")), u=url) == host


@pytest.mark.parametrize(("url", "is_link"), [("http://h/iiif/1/manifest", True), ("http://h/a.json", True), ("http://h/a.json?x", False), ("http://h/a.jpg", False)])
def test_manifest_link(spark, url, is_link):
    assert value(spark, urls.is_manifest_link(F.col("u")), u=url) is is_link


def test_strip_takes_all_white_space(spark):
    assert value(spark, ids.strip(F.col("s")), s=" \t 007 \r") == "007"
    assert "".join(c for c in map(chr, range(0x10000)) if c.isspace()) == "".join(sorted(ids.WHITE_SPACE))
    assert value(spark, ids.strip(F.col("s")), s="\u3000\u00a01 2\x1c") == "1 2"


@pytest.mark.parametrize(
    ("status", "error", "kind", "expected"),
    [
        (429, None, None, "rate_limit"),
        (503, None, "image/jpeg", "server_error"),
        (404, None, None, "http_error"),
        (200, None, None, "ok_untyped"),
        (200, None, "", "ok_untyped"),
        (200, None, "Text/HTML; charset=utf-8", "bad_type"),
        (200, None, "APPLICATION/XML", "bad_type"),
        (200, None, "image/png", "ok"),
        (None, "timeout", None, "timeout"),
        (None, "exception", None, "exception"),
    ],
)
def test_outcome(spark, status, error, kind, expected):
    df = spark.createDataFrame([(status, error, kind)], "s int, e string, k string")
    assert df.select(http.outcome(F.col("s"), F.col("e"), F.col("k"))).first()[0] == expected


@pytest.mark.parametrize(
    ("outcome", "header", "seconds"),
    [
        ("rate_limit", "120", 120),
        ("rate_limit", "0", 0),
        ("rate_limit", "-5", -5),
        ("rate_limit", "Mon, 01 Jan 2024 00:02:00 GMT", 120),
        ("rate_limit", "Sun, 31 Dec 2023 00:00:00 GMT", 0),
        ("rate_limit", "soon", 1800),
        ("rate_limit", "", 1800),
        ("rate_limit", None, 1800),
        ("rate_limit", "12.5", 1800),
        ("rate_limit", "9000000000", 9 * 10**9),
        ("rate_limit", "99999999999999999999", http.LONGEST_WAIT),
        ("rate_limit", "Mon, 01 Jan 2024 01:02:00 +0100", 120),
        ("rate_limit", "Monday, 01-Jan-24 00:02:00 GMT", 120),
        ("rate_limit", "Mon, 01 Jan 2024 00:02 GMT", 120),
        ("timeout", "120", 3600),
        ("server_error", "120", None),
    ],
)
def test_cooldown(spark, outcome, header, seconds):
    at = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1e6)
    df = spark.createDataFrame([(outcome, header, at)], "o string, h string, t bigint")
    micros = df.select(http.cooldown_micros(F.col("o"), F.col("h"), F.col("t"))).first()[0]
    assert micros == (None if seconds is None else seconds * 1_000_000)


def test_plain_timestamps_are_utc_in_any_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-07-01 00:00:00' AS ts")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(http.epoch_micros(df, "ts")).first()[0] == 1719792000000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    ("stem", "path"),
    [("12", "s/12/000/12.jpg"), ("12345", "s/123/000/12345.jpg"), ("123456", "s/123/456/123456.jpg"), ("1234567", "s/123/456/1234567.jpg"), ("000001000", "s/000/001/000001000.jpg")],
)
def test_store_path(spark, stem, path):
    assert value(spark, store.store_path("s", F.col("s")), s=stem) == path


@pytest.mark.parametrize(("name", "stem"), [("a/b/1.jpg", "1"), ("x.tar.gz", "x.tar"), (".hidden", ".hidden"), ("plain", "plain")])
def test_stem(spark, name, stem):
    assert value(spark, store.stem_of(F.col("p")), p=name) == stem


@pytest.mark.parametrize(("path", "found"), [("a.jpg", True), ("a.JPG", True), ("a.Jpg", False), ("a.TIFF", True), ("ajpg", False)])
def test_image_file(spark, path, found):
    assert value(spark, store.is_image_file(F.col("p")), p=path) is found


@pytest.mark.parametrize(("n", "gate"), [(0, "skip_empty"), (1, "skip_small"), (2097151, "skip_small"), (2097152, "resize")])
def test_resize_gate(spark, n, gate):
    assert value(spark, store.resize_gate(F.col("n")), n=n) == gate


def test_fit_truncates_like_floating_point(spark):
    w, h = F.lit(1122), F.lit(800)
    got = spark.range(1).select(store.fit_edge(w, w, h, 1024), store.fit_edge(h, w, h, 1024)).first()
    assert tuple(got) == (int(1122 * (1024 / 1122.0)), int(800 * (1024 / 1122.0))) == (1023, 730)


@pytest.mark.parametrize("box", [1024, 1600])
def test_fit_agrees_with_python_for_all_widths(spark, box):
    df = spark.range(1, 4000).select(F.col("id").cast("int").alias("w"))
    got = df.select("w", store.fit_edge(F.col("w"), F.col("w"), F.lit(300), box).alias("n")).collect()
    for w, n in got:
        scale = min(box / float(max(w, 300)), 1.0)
        assert n == (int(w * scale) if scale < 1.0 else w)


def test_caption_prints_none_and_name_stays_null(spark):
    df = spark.createDataFrame([("s", None, "f", "i")], "s string, g string, f string, i string")
    cap, name = df.select(
        text.caption(F.col("s"), F.col("g"), F.col("f"), F.col("i")),
        text.scientific_name(F.col("f"), F.col("g"), F.col("s")),
    ).first()
    assert cap == "This is an image of species s, in the genus None of family f. It is part of the collection of institution i."
    assert name is None


def test_word_of_a_short_name_is_null(spark):
    assert value(spark, text.word(F.col("n"), 1), n="single") is None
