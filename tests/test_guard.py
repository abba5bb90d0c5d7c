"""Guard replay against a plain loop: chunked, streamed, and its parts."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sheafwork.operators import guard
from sheafwork.operators.skew import Heavy

SCHEMA = "host string, ts_us bigint, attempt_id bigint, is_error int, rest_us bigint"


def expected_decisions(events, threshold=50):
    state, out = {}, {}
    for host, ts, attempt, is_error, rest in sorted(events, key=lambda r: (r[0], r[1], r[2])):
        errors, until = state.get(host, (0, None))
        if errors >= threshold:
            out[attempt] = "skip_breaker"
            continue
        if until is not None and ts < until:
            out[attempt] = "skip_cooldown"
            continue
        out[attempt] = "sent"
        state[host] = (errors + is_error, until if rest is None else ts + rest)
    return out


def log(n, seed, span, longest, error_share):
    rng = random.Random(seed)
    events = []
    for i in range(n):
        host = "hot" if rng.random() < 0.7 else f"h{rng.randrange(6)}"
        asks = rng.random() < 0.3
        rest = rng.choice([0, -3, rng.randrange(1, longest + 1)]) if asks else None
        events.append((host, rng.randrange(span), i, int(not asks and rng.random() < error_share), rest))
    return events


def decided(df):
    return {r["attempt_id"]: r["decision"] for r in df.collect()}


# Rests short and long against the time between attempts; breaker never, late and early.
CASES = [(3000, 1, 10**6, 50, 0.001), (3000, 2, 10**6, 30_000, 0.01), (3000, 3, 500, 40, 0.3), (3000, 4, 10**6, 400_000, 0.05), (40, 5, 100, 30, 0.5)]


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("batch", [11, 10_000])
def test_chunked_replay(many_chunks, case, batch):
    events = log(*case)
    df = many_chunks.createDataFrame(events, SCHEMA).repartition(3)
    many_chunks.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    everything = Heavy("host", tuple((h, 2) for h in sorted({e[0] for e in events})))
    try:
        for heavy in (None, everything, Heavy("host", ())):
            assert decided(guard.replay_events(df, heavy=heavy)) == expected_decisions(events)
    finally:
        many_chunks.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_breaker_opens_at_the_fiftieth_error(spark):
    events = [("h", i, i, 1, None) for i in range(52)]
    got = decided(guard.replay_events(spark.createDataFrame(events, SCHEMA)))
    assert [got[i] for i in (48, 49, 50, 51)] == ["sent", "sent", "skip_breaker", "skip_breaker"]


def test_a_later_shorter_rest_replaces_a_longer_one(spark):
    events = [("h", 0, 1, 0, 100), ("h", 100, 2, 0, 5), ("h", 104, 3, 0, None), ("h", 105, 4, 0, None)]
    got = decided(guard.replay_events(spark.createDataFrame(events, SCHEMA)))
    assert got == {1: "sent", 2: "sent", 3: "skip_cooldown", 4: "sent"}


asking = st.lists(st.tuples(st.integers(0, 200), st.integers(1, 60)), max_size=40)


@settings(max_examples=300, deadline=None)
@given(asking, st.integers(-10, 260))
def test_steps_give_the_rest_a_replay_ends_with(rows, start):
    rows.sort(key=lambda r: r[0])
    ts = np.array([r[0] for r in rows], dtype=np.int64)
    rest = np.array([r[1] for r in rows], dtype=np.int64)
    latest, ends = guard.chunk_steps(ts, rest)
    at = int(np.searchsorted(latest, start, side="left"))
    by_steps = int(ends[at]) if at < len(latest) else start
    assert by_steps == guard.replay(ts, rest, start)[1]
    assert (np.diff(latest) > 0).all()


def pairs(rows):
    rows.sort(key=lambda r: r[0])
    return np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int64)


@settings(max_examples=300, deadline=None)
@given(asking, asking, st.integers(-10, 300))
def test_composed_steps_are_one_after_the_other(first, then, start):
    first, then = pairs(first), pairs([(ts + 100, rest) for ts, rest in then])
    one, two = guard.chunk_steps(*first), guard.chunk_steps(*then)
    both = guard.compose(one, two)
    assert guard.after(both, start) == guard.after(two, guard.after(one, start))
    assert (np.diff(both[0]) > 0).all()


def test_a_thousand_chunks_compose_like_one_replay():
    """One host, 1,000 chunks: whatever the bracketing, and never more than the steps of the two that meet."""
    rng = np.random.default_rng(3)
    ts = np.sort(rng.integers(0, 10**7, 20_000))
    rest = rng.integers(1, 3000, 20_000)
    chunks = [guard.chunk_steps(ts[i : i + 20], rest[i : i + 20]) for i in range(0, 20_000, 20)]
    level = chunks
    while len(level) > 1:
        level = [
            guard.compose(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)
        ]
    resting = guard.NEVER
    for steps in chunks:
        resting = guard.after(steps, resting)
    assert guard.after(level[0], guard.NEVER) == resting == guard.replay(ts, rest, guard.NEVER)[1]


@pytest.mark.parametrize("fan", [2, 3])
def test_replay_over_many_levels(many_chunks, monkeypatch, fan):
    """One host with nine tenths of the log, 40 chunks, folded two or three at a time."""
    monkeypatch.setattr(guard, "FAN", fan)
    rng = random.Random(11)
    events = [(h if rng.random() < 0.1 else "hot", t, i, e, r) for i, (h, t, _, e, r) in enumerate(log(4000, 6, 10**6, 90_000, 0.001))]
    before = many_chunks.conf.get("spark.sql.shuffle.partitions")
    many_chunks.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        df = many_chunks.createDataFrame(events, SCHEMA)
        assert decided(guard.replay_events(df)) == expected_decisions(events)
    finally:
        many_chunks.conf.set("spark.sql.shuffle.partitions", before)
