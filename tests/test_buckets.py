"""Tables in hash buckets: id lists and totals over many updates, reruns, broken updates and plain text lists."""

from __future__ import annotations

import os
import random

import pytest
from conftest import rows

from sheafwork.sinks import buckets
from sheafwork.sinks.buckets import BucketTable
from sheafwork.sinks.checkpoint import append_ids, table_of
from sheafwork.sources.idlist import beside, read_id_set, read_lines
from sheafwork.streaming import checkpoint, totals


def ids_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id string").coalesce(1)


def files_of(df) -> list[str]:
    return [f.removeprefix("file:") for f in df.inputFiles()]


@pytest.fixture
def few_partitions(spark):
    """Many tiny updates need no eight tasks each."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_two_hundred_triggers_keep_files_and_reads_bounded(few_partitions, tmp_path, monkeypatch):
    spark, path, rng = few_partitions, str(tmp_path / "list"), random.Random(1)
    read = []
    plain_rows = BucketTable.rows

    def watched(self, version=None, some=None):
        found = plain_rows(self, version, some)
        if some is not None and version is not None:
            read.append((set(some), files_of(found)))
        return found

    monkeypatch.setattr(BucketTable, "rows", watched)
    expected: dict[str, int] = {}
    for n in range(200):
        values = [str(rng.randrange(600)) for _ in range(3)]
        checkpoint.append_trigger(ids_of(spark, values), n, path)
        for v in values:
            expected.setdefault(v, n)
    monkeypatch.undo()
    for touched, files in read:
        assert len(touched) <= 3 and {int(f.split("bucket=")[1].split("/")[0]) for f in files} <= touched
        assert len(files) <= len(touched) * buckets.MERGE_AT
    assert dict(rows(checkpoint.read_list(spark, path))) == expected
    stored = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(stored) <= buckets.BUCKETS * (buckets.MERGE_AT + 2) + 2


def test_repeated_batches_change_nothing(spark, tmp_path):
    path = str(tmp_path / "list")
    append_ids(ids_of(spark, ["a", "b", "b", None]), path, batch=0)
    append_ids(ids_of(spark, ["b", "c"]), path, batch=1)
    once = rows(checkpoint.read_list(spark, path))
    assert once == [("a", 0), ("b", 0), ("c", 1)]
    append_ids(ids_of(spark, ["b", "c", "late"]), path, batch=1)
    append_ids(ids_of(spark, ["a"]), path, batch=0)
    assert rows(checkpoint.read_list(spark, path)) == once


def test_an_update_that_dies_before_the_switch_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "list")
    append_ids(ids_of(spark, ["a", "b"]), path, batch=0)
    with monkeypatch.context() as broken:
        broken.setattr(BucketTable, "_switch", lambda self, version: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            append_ids(ids_of(spark, ["c", "d"]), path, batch=1)
    assert [r[0] for r in rows(checkpoint.read_list(spark, path))] == ["a", "b"]
    append_ids(ids_of(spark, ["c", "d"]), path, batch=1)
    assert [r[0] for r in rows(checkpoint.read_list(spark, path))] == ["a", "b", "c", "d"]


def test_a_reader_keeps_the_version_it_opened(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), "n bigint", buckets=1)
    put = lambda n, batch: table.put(spark.createDataFrame([("k", n)], "key string, n bigint"), batch)
    for batch in range(buckets.MERGE_AT):
        put(batch, batch)
    opened = table.rows()
    put(100, 100)  # rewrites the bucket
    assert opened.count() == buckets.MERGE_AT and table.rows().count() == 1
    assert rows(table.latest()) == [("k", 100)]


@pytest.mark.parametrize("as_folder", [False, True])
def test_plain_text_lists_are_appended_to(spark, tmp_path, as_folder):
    """The plain list stays as it is; what is appended lies beside it, and lines written to it meanwhile count."""
    path = tmp_path / "processed_ids.txt"
    file = path / "part-0" if as_folder else path
    file.parent.mkdir(exist_ok=True)
    file.write_text("1\n2 \n\n2\n007\n")
    append_ids(ids_of(spark, ["2", "3", "3"]), str(path))
    append_ids(ids_of(spark, ["3", "4"]), str(path), batch=5)
    assert file.read_text() == "1\n2 \n\n2\n007\n"
    assert rows(read_id_set(spark, str(path))) == [("007",), ("1",), ("2",), ("3",), ("4",)]
    assert sorted(r[0] for r in read_lines(spark, str(path)).collect()) == ["", "007", "1", "2", "2 ", "3", "4"]
    with open(file, "a") as more:
        more.write("5\n")
    append_ids(ids_of(spark, ["5", "6"]), str(path), batch=6)
    assert sorted(r[0] for r in read_lines(spark, str(path)).collect()) == ["", "007", "1", "2", "2 ", "3", "4", "5", "6"]
    assert table_of(spark, str(path)).path == beside(str(path))


def test_lists_that_do_not_exist_yet(spark, tmp_path):
    path = str(tmp_path / "none.txt")
    assert read_lines(spark, path).count() == 0 and read_id_set(spark, path).count() == 0
    append_ids(ids_of(spark, []), path)
    assert read_lines(spark, path).count() == 0
    append_ids(ids_of(spark, ["x"]), path)
    assert rows(read_lines(spark, path)) == [("x",)]


def test_totals_over_many_triggers_stay_in_few_files(few_partitions, tmp_path):
    spark, path = few_partitions, str(tmp_path / "totals")
    expected = {}
    for n in range(30):
        changed = [(f"h{n % 4}", n), (None, 2 * n)]
        totals.put_totals(spark.createDataFrame(changed, "host string, errors bigint").coalesce(1), n, path)
        expected.update(dict(changed))
    totals.put_totals(spark.createDataFrame([("h1", -5)], "host string, errors bigint"), 29, path)
    assert dict(map(tuple, totals.latest_totals(spark, path).collect())) == expected
    assert len(files_of(BucketTable(spark, path, "errors bigint").rows())) <= 5 * buckets.MERGE_AT


def test_bucket_count_is_the_tables_own(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = spark.range(100).selectExpr("cast(id as string) as key")
    BucketTable(spark, path, buckets=7).add_new(keys)
    table = BucketTable(spark, path, buckets=3)
    table.add_new(keys)
    assert table.rows().count() == 100 and table.version().buckets == 7
