"""Guard replay: which attempts of a demand log would have been sent.

A skipped attempt changes nothing, so each decision rests on earlier decisions. Two facts make the
work divisible:

* Until a breaker opens, it has no say. So cooldowns can be replayed as if there were no breaker;
  the breaker is then a running count of errors among the attempts that replay let through.
* A sent attempt that asks for rest is only sent when the earlier rest is over, so the time until
  which a host rests never moves back. Inside one chunk of a host's log the rest in force at the
  end is therefore a step function of the rest in force at the start, with a step for each
  rest-asking attempt that could come first.

Ordinary hosts are replayed as a stream over sorted partitions. The log of a heavy host (``skew``) is
cut into chunks: every chunk publishes its steps (neighbouring steps with the same end are merged),
neighbouring chunks' steps are composed into steps of both in a tree, which hands each chunk its starting rest, and the
chunks are replayed in parallel. No task holds more than one batch and two chunks' rest-asking attempts or steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.http import BREAKER_ERRORS
from ..staging import staged
from .attempts import ORDER, host_events
from .ordered import CARRY, CHUNK, ROW, KeyRuns, hand_over, ordered_chunks, with_carry
from .skew import Heavy, divided, heavy_keys

NEVER, ALWAYS = np.iinfo(np.int64).min, np.iinfo(np.int64).max
# Segments of a host that are folded into one.
FAN = 32
_GROUP = "_group"
# What is known of a host before its first attempt here: the rest in force and the errors so far.
SEED_REST, SEED_ERRORS = "_seed_rest", "_seed_errors"
REPLAYED = "host string, attempt_id bigint, decision string, sent_error bigint, until bigint"
_STEPS = "host string, _chunk int, latest bigint, ends bigint"
Steps = tuple[np.ndarray, np.ndarray]


def chunk_steps(ts: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of one chunk: starting rest up to ``latest`` ends as rest until ``ends``.

    ``ts`` and ``rest`` are the rest-asking attempts in order. The attempt each one would be
    followed by is looked up at once; following those links by doubling gives the end of every chain.
    """
    n = len(ts)
    if n == 0:
        return ts, ts
    until = ts + rest
    follow = np.searchsorted(ts, until, side="left")
    # The last link of a chain points to itself, so doubling the links settles on the chain's end.
    link = np.where(follow < n, follow, np.arange(n))
    for _ in range(n.bit_length()):
        link = link[link]
    ends = until[link]
    # Of the attempts at one instant only the first can be taken.
    firsts = np.flatnonzero(np.append(True, ts[1:] != ts[:-1]))
    ts, ends = ts[firsts], ends[firsts]
    keep = np.append(ends[1:] != ends[:-1], True)
    return ts[keep], ends[keep]


def replay(ts: np.ndarray, rest: np.ndarray, resting_until: int) -> tuple[np.ndarray, int]:
    """Which attempts of one host pass the cooldown, and the rest in force afterwards."""
    passes = np.ones(len(ts), dtype=bool)
    passes[: np.searchsorted(ts, resting_until, side="left")] = False
    asking = np.flatnonzero(rest > 0)
    at = int(np.searchsorted(ts[asking], resting_until, side="left"))
    while at < len(asking):
        row = int(asking[at])
        resting_until = int(ts[row] + rest[row])
        free = int(np.searchsorted(ts, resting_until, side="left"))
        passes[row + 1 : free] = False
        at = int(np.searchsorted(asking, free, side="left"))
    return passes, resting_until


def _published_steps(chunks: DataFrame, seeded: bool) -> DataFrame:
    """For the first and the last host of each chunk, the steps the chunk applies to its rest.

    Only the last host can go on into the next chunk, so only its steps are real; for a first host
    that ends here there is just the closing step.
    """

    def publish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, first, last, begins = None, None, None, False
        # Rest-asking attempts of the host being read; the next host drops those of the one before.
        ts_parts: list[np.ndarray] = []
        rest_parts: list[np.ndarray] = []
        for batch in batches:
            if batch.empty:
                continue
            newest = batch["host"].iloc[-1]
            if chunk is None:
                chunk, first, last = int(batch[CHUNK].iloc[0]), batch["host"].iloc[0], batch["host"].iloc[0]
            if newest != last:
                ts_parts, rest_parts, begins, last = [], [], True, newest
            mine = batch[(batch["host"] == last).to_numpy()]
            rest = mine["rest_us"].fillna(0).to_numpy(dtype=np.int64)
            asking = np.flatnonzero(rest > 0)
            ts_parts.append(mine["ts_us"].to_numpy(dtype=np.int64)[asking])
            rest_parts.append(rest[asking])
        if chunk is None:
            return
        if first != last:
            yield pd.DataFrame({CHUNK: [chunk], "host": [first], "latest": [ALWAYS], "ends": [NEVER]})
        latest, ends = chunk_steps(np.concatenate(ts_parts), np.concatenate(rest_parts))
        if begins and not seeded:
            # The host starts in this chunk with no rest, so only its very first step can be taken.
            latest, ends = latest[:1], ends[:1]
        # The closing step lets a rest that outlasts the chunk through unchanged.
        yield pd.DataFrame(
            {CHUNK: chunk, "host": last, "latest": np.append(latest, ALWAYS), "ends": np.append(ends, NEVER)}
        )

    return chunks.select(CHUNK, "host", "ts_us", "rest_us").mapInPandas(
        publish, "_chunk int, host string, latest bigint, ends bigint"
    )


def compose(first: Steps, then: Steps) -> Steps:
    """The steps of two neighbours as steps of both; a rest beyond the last step passes through unchanged."""
    if not len(first[0]) or not len(then[0]):
        return first if len(first[0]) else then
    at = np.searchsorted(then[0], first[1], side="left")
    ends = np.where(at < len(then[0]), then[1][np.minimum(at, len(then[0]) - 1)], first[1])
    # What outlasts the first neighbour meets the second as it is.
    beyond = int(np.searchsorted(then[0], first[0][-1], side="right"))
    latest, ends = np.append(first[0], then[0][beyond:]), np.append(ends, then[1][beyond:])
    keep = np.append(ends[1:] != ends[:-1], True)
    return latest[keep], ends[keep]


def after(steps: Steps, resting: int) -> int:
    """The rest in force after the steps."""
    at = int(np.searchsorted(steps[0], resting, side="left"))
    return int(steps[1][at]) if at < len(steps[0]) else resting


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, int, int, Steps]]:
    """(host, group), start of the group, segment and its steps, one segment at a time."""
    open_key, latest, ends, start = None, [], [], NEVER

    def closed() -> tuple[tuple, int, int, Steps]:
        steps = np.concatenate(latest), np.concatenate(ends)
        real = steps[0] != ALWAYS
        return open_key[:2], start, open_key[2], (steps[0][real], steps[1][real])

    runs = KeyRuns(["host", _GROUP, CHUNK])
    for batch in batches:
        if batch.empty:
            continue
        for lo, hi, continued in runs.spans(batch):
            if not continued:
                if open_key is not None:
                    yield closed()
                open_key, latest, ends = (batch["host"].iloc[lo], int(batch[_GROUP].iloc[lo]), int(batch[CHUNK].iloc[lo])), [], []
                handed = batch[CARRY].iloc[lo]
                start = NEVER if pd.isna(handed) else int(handed)
            latest.append(batch["latest"].to_numpy(dtype=np.int64)[lo:hi])
            ends.append(batch["ends"].to_numpy(dtype=np.int64)[lo:hi])
    if open_key is not None:
        yield closed()


def _grouped(level: DataFrame, starts: DataFrame | None) -> DataFrame:
    """Segments of a level, ``FAN`` neighbours to a group, in order, with the rest the group starts with."""
    rows = level.withColumn(_GROUP, F.floor(F.col(CHUNK) / FAN).cast("int"))
    if starts is None:
        rows = rows.withColumn(CARRY, F.lit(None).cast("bigint"))
    else:
        # At most two rows per chunk, or one per heavy host.
        handed = F.broadcast(starts.withColumnRenamed(CHUNK, _GROUP))
        rows = rows.join(handed, ["host", _GROUP], "left")
    return rows.repartition("host", _GROUP).sortWithinPartitions("host", _GROUP, CHUNK, "latest")


def _folded(level: DataFrame) -> DataFrame:
    """The next level: a group's segments as one."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, whole = None, None

        def out() -> pd.DataFrame:
            return pd.DataFrame(
                {"host": key[0], CHUNK: key[1], "latest": np.append(whole[0], ALWAYS), "ends": np.append(whole[1], NEVER)}
            )

        for own, _, _, steps in _segments(batches):
            if own != key:
                if key is not None:
                    yield out()
                key, whole = own, steps
            else:
                whole = compose(whole, steps)
        if key is not None:
            yield out()

    return staged(_grouped(level, None).mapInPandas(fold, _STEPS).select("host", CHUNK, "latest", "ends"), "guard-steps")


def _handed_down(level: DataFrame, starts: DataFrame | None) -> DataFrame:
    """Rest in force when each segment starts, from the rest its group starts with."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, resting, found = None, NEVER, []
        for own, start, segment, steps in _segments(batches):
            if own != key:
                key, resting = own, start
            if resting != NEVER:
                found.append((own[0], segment, resting))
            resting = after(steps, resting)
        if found:
            yield pd.DataFrame(found, columns=["host", CHUNK, CARRY])

    return _grouped(level, starts).mapInPandas(walk, "host string, _chunk int, _carry bigint")


def _starting_rest(chunks: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Rest in force when a chunk starts, for its first and last host; at most two rows per chunk.

    Steps compose, and composing is associative. So ``FAN`` neighbours are folded into one segment until a host
    has ``FAN`` segments at most, and what starts them is handed down level by level. A task holds the steps
    of a group so far and those of one more segment.
    """
    levels = [staged(_published_steps(chunks, seeds is not None).select("host", CHUNK, "latest", "ends"), "guard-steps")]
    segments = (levels[0].agg(F.max(CHUNK)).first()[0] or 0) + 1
    while segments > FAN:
        levels.append(_folded(levels[-1]))
        segments = -(-segments // FAN)
    # All segments of the last level are one group, which starts with what is known of the host.
    starts = None if seeds is None else seeds.select("host", F.lit(0).alias(CHUNK), F.col(SEED_REST).alias(CARRY))
    for level in reversed(levels):
        starts = _handed_down(level, starts)
    return starts


def _replayed(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, list]]:
    """Each batch with the attempts that pass the cooldown and its host spans."""
    runs, resting = KeyRuns(["host"]), NEVER
    for batch in batches:
        if batch.empty:
            continue
        ts = batch["ts_us"].to_numpy(dtype=np.int64)
        rest = batch["rest_us"].fillna(0).to_numpy(dtype=np.int64)
        handed = batch["_rest"]
        passes = np.empty(len(batch), dtype=bool)
        spans = runs.spans(batch)
        for lo, hi, continued in spans:
            if not continued:
                resting = NEVER if pd.isna(handed.iloc[lo]) else int(handed.iloc[lo])
            passes[lo:hi], resting = replay(ts[lo:hi], rest[lo:hi], resting)
        yield batch, passes, spans


def _sent_errors(rested: DataFrame) -> DataFrame:
    """Errors let through by the cooldown, for the first and the last host of each chunk."""

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, order, sums = None, [], {}
        for batch, passes, spans in _replayed(batches):
            chunk = int(batch[CHUNK].iloc[0])
            errors = batch["is_error"].to_numpy() * passes
            for lo, hi, _ in spans:
                host = batch["host"].iloc[lo]
                sums[host] = sums.get(host, 0) + int(errors[lo:hi].sum())
                if host not in order:
                    order.append(host)
                if len(order) > 2:
                    del sums[order.pop(1)]
        if chunk is not None:
            yield pd.DataFrame({CHUNK: chunk, "host": order, "n": [sums[h] for h in order]})

    return rested.mapInPandas(total, "_chunk int, host string, n bigint")


def guard_replay(attempts: DataFrame, threshold: int = BREAKER_ERRORS) -> DataFrame:
    """Decision per attempt: ``sent``, ``skip_breaker`` or ``skip_cooldown``.

    Attempts of a host are taken in order of time, then attempt id; the breaker is asked first.
    """
    return replay_events(host_events(attempts), threshold)


def replay_events(
    events: DataFrame, threshold: int = BREAKER_ERRORS, heavy: Heavy | None = None, seeds: DataFrame | None = None
) -> DataFrame:
    return replay_rows(events, threshold, heavy, seeds).select("attempt_id", "decision")


def replay_rows(
    events: DataFrame, threshold: int = BREAKER_ERRORS, heavy: Heavy | None = None, seeds: DataFrame | None = None
) -> DataFrame:
    """``host``, ``attempt_id``, ``decision``, ``sent_error`` (1 for an error the cooldown let through) and ``until``
    (the rest a let-through attempt asked for).

    ``seeds`` says what is known of a host: ``host``, ``SEED_REST`` and ``SEED_ERRORS``, one row each.
    """
    narrow = events.select("host", "ts_us", "attempt_id", "is_error", "rest_us")
    heavy = heavy or heavy_keys(narrow, "host")["host"]
    light, massive = divided(narrow, heavy)
    if seeds is not None:
        known, listed = divided(seeds.select("host", SEED_REST, SEED_ERRORS), heavy)
        light = light.join(known.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
        # At most half as many hosts as there are partitions.
        massive, listed = massive.join(F.broadcast(listed), "host", "left"), listed
    else:
        none = {SEED_REST: F.lit(None).cast("bigint"), SEED_ERRORS: F.lit(None).cast("bigint")}
        light, massive, listed = light.withColumns(none), massive.withColumns(none), None
    ready = light.repartition("host").sortWithinPartitions("host", *ORDER)
    decided = _decided(ready.withColumnsRenamed({SEED_REST: "_rest", SEED_ERRORS: "_errors"}), threshold)
    return decided.unionAll(_decided(_chunked(massive, listed), threshold)) if heavy.tasks else decided


def _chunked(events: DataFrame, seeds: DataFrame | None) -> DataFrame:
    """Rows in chunks, with the rest and the errors each chunk starts with."""
    chunks = ordered_chunks(events, ["host", *ORDER]).drop(ROW)
    rested = with_carry(chunks, _starting_rest(chunks, seeds), "host", "_rest").withColumn("_rest", F.coalesce("_rest", SEED_REST))
    errors = hand_over(_sent_errors(rested), "host", lambda w: F.sum("n").over(w))
    carried = with_carry(rested, errors, "host", "_errors")
    before = F.coalesce("_errors", F.lit(0)) + F.coalesce(SEED_ERRORS, F.lit(0))
    return carried.withColumn("_errors", before).drop(SEED_REST, SEED_ERRORS)


def _decided(ready: DataFrame, threshold: int) -> DataFrame:
    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        so_far = 0
        for batch, passes, spans in _replayed(batches):
            errors = batch["is_error"].to_numpy(dtype=np.int64) * passes
            before = np.cumsum(errors) - errors
            handed = batch["_errors"]
            for lo, hi, continued in spans:
                if not continued:
                    so_far = 0 if pd.isna(handed.iloc[lo]) else int(handed.iloc[lo])
                before[lo:hi] += so_far - before[lo]
                so_far += int(errors[lo:hi].sum())
            decision = np.where(before >= threshold, "skip_breaker", np.where(passes, "sent", "skip_cooldown"))
            rest = batch["rest_us"].fillna(0).to_numpy(dtype=np.int64)
            until = pd.array(batch["ts_us"].to_numpy(dtype=np.int64) + rest, dtype="Int64")
            until[~(passes & (rest > 0))] = pd.NA
            rows = {"host": batch["host"], "attempt_id": batch["attempt_id"], "decision": decision, "sent_error": errors, "until": until}
            yield pd.DataFrame(rows)

    return ready.mapInPandas(decide, REPLAYED)
