"""Streams fed in several triggers against the batch results."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import rows
from test_guard import SCHEMA, decided, expected_decisions, log

from sheafwork import queries_files
from sheafwork.operators import guard as replay_module
from sheafwork.streaming import checkpoint, guard, milestones, totals


def feed(spark, folder: str, batches: list[list[tuple]], schema: str, start, stop_after: int | None = None):
    """Write one file per trigger and run the query until it has read it; restarts it once on the way."""
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
        if n == 0 or n == stop_after:
            query = start()
        query.processAllAvailable()
        if stop_after is not None and n == stop_after - 1:
            query.stop()
    query.stop()


@pytest.mark.parametrize("seed", [1, 2])
def test_guard_stream_equals_replay(spark, tmp_path, seed):
    events = sorted(log(1500, seed, 10**6, 60_000, 0.1), key=lambda r: (r[1], r[2]))
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([], SCHEMA).write.parquet(source)

    def start():
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        return guard.guard_writer(stream, out).option("checkpointLocation", state).start()

    feed(spark, source, [events[:400], events[400:401], events[401:1100], events[1100:]], SCHEMA, start, stop_after=2)
    assert decided(guard.decisions(spark, out)) == expected_decisions(events)


@pytest.mark.parametrize("case", [(2400, 7, 10**6, 60_000, 0.02), (2400, 8, 900, 70, 0.2)])
def test_hot_host_of_a_trigger_is_cut_over_tasks(many_chunks, tmp_path, monkeypatch, case):
    """Three triggers in which one host owns most rows, decided in chunks and seeded by the triggers before."""
    spark, out = many_chunks, str(tmp_path / "out")
    events = sorted(log(*case), key=lambda r: (r[1], r[2]))
    chunked = []
    whole = replay_module._chunked

    def watched(rows, seeds):
        found = whole(rows, seeds)
        chunked.append(found.select("_chunk").distinct().count())
        return found

    monkeypatch.setattr(replay_module, "_chunked", watched)
    for n, part in enumerate((events[:800], events[800:1600], events[1600:])):
        guard.decide_trigger(spark.createDataFrame(part, SCHEMA).repartition(4), n, out)
    assert decided(guard.decisions(spark, out)) == expected_decisions(events)
    assert len(chunked) == 3 and min(chunked) >= 6


def test_a_repeated_trigger_gives_the_same_decisions(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    events = sorted(log(900, 9, 10**5, 9000, 0.1), key=lambda r: (r[1], r[2]))
    frames = [spark.createDataFrame(part, SCHEMA) for part in (events[:300], events[300:600], events[600:])]
    guard.decide_trigger(frames[0], 0, out)
    with monkeypatch.context() as broken:
        broken.setattr(guard.BucketTable, "put", lambda *given: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            guard.decide_trigger(frames[1], 1, out)
    for n in (1, 1, 0, 2, 2):
        guard.decide_trigger(frames[n], n, out)
    assert decided(guard.decisions(spark, out)) == expected_decisions(events)
    errors = {r["key"]: r["errors"] for r in guard.host_states(spark, out).latest().collect()}
    assert set(errors) == {e[0] for e in events}


def test_id_list_stream_survives_a_repeated_trigger(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([], "id string").write.parquet(source)

    def start():
        stream = spark.readStream.schema("id string").parquet(source)
        return checkpoint.id_list_writer(stream, out).option("checkpointLocation", state).start()

    feed(spark, source, [[("1",), ("2",), ("2",)], [("2",), ("3",)], [("1",), ("4",)]], "id string", start, stop_after=1)
    once = rows(checkpoint.read_list(spark, out))
    assert [r[0] for r in once] == ["1", "2", "3", "4"]
    last = max(r[1] for r in once)
    checkpoint.append_trigger(spark.createDataFrame([("1",), ("4",)], "id string"), last, out)
    assert rows(checkpoint.read_list(spark, out)) == once


def test_rolling_errors(spark, tmp_path):
    events = log(600, 3, 10**6, 1000, 0.4)
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([], SCHEMA).write.parquet(source)

    def start():
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        return totals.totals_writer(totals.rolling_errors(stream), out).option("checkpointLocation", state).start()

    feed(spark, source, [events[:100], events[100:300], events[300:]], SCHEMA, start)
    expected = {}
    for host, _, _, is_error, _ in events:
        expected[host] = expected.get(host, 0) + is_error
    assert dict(rows(totals.latest_totals(spark, out))) == {h: n for h, n in expected.items() if n}


def test_milestones_count_on_over_triggers(spark, tmp_path):
    schema = "gbif_id bigint, attempt_id bigint, ts_us bigint"
    hits = [(1000 + i, i, 5 * i) for i in range(100)]
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([], schema).write.parquet(source)

    def start():
        stream = spark.readStream.schema(schema).parquet(source)
        return milestones.milestones_writer(stream, out, every=30, stored=10).option("checkpointLocation", state).start()

    feed(spark, source, [hits[:35], hits[35:36], hits[36:]], schema, start)
    assert rows(milestones.reached(spark, out)) == [(30, 1019), (60, 1049), (90, 1079)]


def test_id_lines_in_many_files_take_a_fixed_number_of_triggers(spark, tmp_path, monkeypatch):
    paths, own = {}, queries_files.stage_path
    monkeypatch.setattr(queries_files, "stage_path", lambda s, label: paths.setdefault(label, own(s, label)))
    orders = spark.createDataFrame([(k, "FPO"[k % 3]) for k in range(1, 61)], "o_orderkey bigint, o_orderstatus string")
    orders.repartition(4).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1,)], "r_regionkey int").write.parquet(str(tmp_path / "region.parquet"))
    cost = "spark.sql.files.openCostInBytes"
    spark.conf.set(cost, "128m")
    try:
        found = rows(queries_files.st_checkpoint(spark, str(tmp_path)))
    finally:
        spark.conf.unset(cost)
    files = spark.read.parquet(paths["id_lines"]).inputFiles()
    triggers = [p for p in Path(paths["progress"], "commits").iterdir() if p.name.isdigit()]
    assert len(files) > 8 and len(triggers) <= queries_files.ID_TRIGGERS
    assert found == sorted(((str(k * 37), 1) for k in range(1, 61) if k % 3 != 2), key=repr)
