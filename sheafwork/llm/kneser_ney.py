"""Language-model scoring: an interpolated modified Kneser-Ney model of word pairs.

Counted in Spark: every task counts its words (then its pairs) as sorted arrays and sends one compact row
per part of the hash range; a part's rows are added up by one task, which writes them as sorted hash
arrays to the shared folder. Workers memory-map these arrays and look their texts' words and pairs
up by binary search.

Files of a model: ``words-k`` and ``counts-k`` (word hashes, ascending over the parts, and counts; a word's
place among all is its number), ``pairs-k`` and ``pair_counts-k`` (mixed hash of context and word number),
and per range of ``RANGE`` word numbers ``context_sums-k``, ``context_kinds-k`` (as context: sum of
counts; pairs seen once, twice, three times or more) and ``befores-k`` (different words before it).

    p(w | v) = max(c(vw) - D(c), 0) / c(v) + g(v) * p0(w)
    p0(w)    = max(a(w) - D'(a), 0) / A    + g0   / (V + 1)

a(w) counts the different words before w, A is their sum, D and D' are the three modified discounts of
either level, g gives back what they take, and one of the V + 1 places is for words never seen.

Defined results: a null text is an empty one, whose only token is its end; a model without training
documents gives every token the uniform 1 / (V + 1) of its empty vocabulary; repeated rows count again;
words are compared by 64-bit hashes; extra columns stay (those named like a result are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..staging import stage_path, staged
from .packed import from_planes, map_array, pack, part_bits, planes, summed, unpack, write_array
from .words import batch_words, mix, slices

# Word numbers per file of per-word values.
RANGE = 1 << 16
# Keys a task gathers before it sends what it has; bounds its memory, not the result.
GATHERED = 2_000_000
# Bytes of texts worked on at once.
SLICE = 1 << 21
# Stands for the end of a text.
END = np.uint64(0x5EED0FE2D0FF1CE5)
_U = np.uint64
_ROW = "part int, keys binary, counts binary"
_STATS = "part int, keys binary, sums binary, ones binary, twos binary, more binary, befores binary"


def with_ends(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, and where each text starts (one more than texts)."""
    words, starts = batch_words(column, lower=True)
    return np.insert(words, starts[1:], END), starts + np.arange(len(starts))


class Words:
    """Vocabulary of a model: numbers and counts of word hashes."""

    def __init__(self, folder: str, bits: int, sizes: tuple[int, ...]):
        self.bits = bits
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.keys = [map_array(folder, f"words-{k}", np.uint64) if n else np.empty(0, np.uint64) for k, n in enumerate(sizes)]
        self.counts = [map_array(folder, f"counts-{k}", np.int64) if n else np.empty(0, np.int64) for k, n in enumerate(sizes)]

    def __len__(self) -> int:
        return int(self.first[-1])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (one past the last for unknown words) and count of each hash."""
        distinct, back = np.unique(hashes, return_inverse=True)
        numbers, counts = np.full(len(distinct), len(self), np.int64), np.zeros(len(distinct), np.int64)
        for k, found, at in located(distinct, self.keys, self.bits):
            numbers[found], counts[found] = self.first[k] + at, self.counts[k][at]
        return numbers[back], counts[back]


def located(keys: np.ndarray, files: list[np.ndarray], bits: int):
    """For ascending ``keys``: part number, which keys it holds, and their places there."""
    edges = np.searchsorted(keys, np.arange(len(files), dtype=np.uint64) << _U(64 - bits))
    for k, (a, b) in enumerate(zip(edges, np.append(edges[1:], len(keys)))):
        if a == b or not len(files[k]):
            continue
        at = np.searchsorted(files[k], keys[a:b])
        at[at == len(files[k])] = 0
        hit = files[k][at] == keys[a:b]
        yield k, a + np.flatnonzero(hit), at[hit]


@dataclass(frozen=True)
class Model:
    folder: str
    bits: int
    sizes: tuple[int, ...]
    pair_sizes: tuple[int, ...]
    tokens: int
    discounts: tuple[float, ...]
    low_discounts: tuple[float, ...]
    pairs: int
    given_back: float


class _Counter:
    """Adds up keys of a task and sends them as rows when there are ``GATHERED``, and at the end."""

    def __init__(self, part):
        self.part, self.keys, self.counts, self.held = part, [], [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        distinct, counts = np.unique(keys, return_counts=True)
        self.keys.append(distinct)
        self.counts.append(counts)
        self.held += len(distinct)
        if self.held > GATHERED:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.keys:
            return
        keys, counts = summed(np.concatenate(self.keys), np.concatenate(self.counts))
        self.keys, self.counts, self.held = [], [], 0
        parts = self.part(keys)
        order = np.argsort(parts, kind="stable")
        cuts = np.flatnonzero(np.diff(parts[order], prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            own = order[a:b]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(parts[own[0]])], pa.int32()),
                    pa.array([pack(keys[own])], pa.binary()),
                    pa.array([planes(counts[own].astype(np.int64))], pa.binary()),
                ],
                names=["part", "keys", "counts"],
            )


def _added_up(table: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    keys = [unpack(k) for k in table.column("keys").to_pylist()]
    counts = [from_planes(c, np.int64) for c in table.column("counts").to_pylist()]
    return (table.column("part")[0].as_py(), *summed(np.concatenate(keys), np.concatenate(counts)))


def count_words(docs: DataFrame, folder: str, bits: int) -> list:
    """Write the vocabulary; one row per part comes back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Counter(lambda keys: (keys >> _U(64 - bits)).astype(np.int64))
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield from gathered.add(with_ends(part.column("text"))[0])
        yield from gathered.rows()

    def store(table: pa.Table) -> pa.Table:
        part, keys, counts = _added_up(table)
        write_array(folder, f"words-{part}", keys)
        write_array(folder, f"counts-{part}", counts)
        return pa.table({"part": pa.array([part], pa.int32()), "n": [len(keys)], "tokens": [int(counts.sum())]})

    counted = docs.select("text").mapInArrow(count, _ROW)
    return counted.groupBy("part").applyInArrow(store, "part int, n bigint, tokens bigint").collect()


def _discounts(n: np.ndarray) -> tuple[float, ...]:
    """Modified discounts from how many keys were counted once, twice, three and four times."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if min(n1, n2, n3) <= 0:
        return 0.0, 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return 0.0, *(min(max(d, 0.0), float(k)) for k, d in enumerate(raw, 1))


def train(docs: DataFrame) -> Model:
    """Count ``docs`` and write the model to the shared folder.

    Two passes over the texts. The driver gets one row of sums per part.
    """
    spark = docs.sparkSession
    folder = stage_path(spark, "kneser-ney")
    bits = part_bits(int(spark.conf.get("spark.sql.shuffle.partitions")))
    sizes, tokens = [0] * (1 << bits), 0
    for row in count_words(docs, folder, bits):
        sizes[row["part"]], tokens = row["n"], tokens + row["tokens"]
    sizes = tuple(sizes)
    known = sum(sizes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(folder, bits, sizes)
        gathered = _Counter(lambda keys: (mix(keys) >> _U(64 - bits)).astype(np.int64))
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                hashes, starts = with_ends(part.column("text"))
                yield from gathered.add(pair_keys(words.find(hashes)[0], starts, known))
        yield from gathered.rows()

    def store(table: pa.Table) -> pa.Table:
        part, keys, counts = _added_up(table)
        hashed = mix(keys)
        order = np.argsort(hashed)
        write_array(folder, f"pairs-{part}", hashed[order])
        write_array(folder, f"pair_counts-{part}", counts[order].astype(np.int64))
        context, word = (keys >> _U(32)).astype(np.uint64), keys & _U(0xFFFFFFFF)
        kinds = [(counts == 1).astype(np.int64), (counts == 2).astype(np.int64), (counts > 2).astype(np.int64)]
        as_context = summed(context, counts, *kinds)
        as_word = summed(word, np.ones(len(word), np.int64))
        ids = np.union1d(as_context[0], as_word[0])
        columns = [np.zeros(len(ids), np.int64) for _ in range(5)]
        for k in range(4):
            columns[k][np.searchsorted(ids, as_context[0])] = as_context[k + 1]
        columns[4][np.searchsorted(ids, as_word[0])] = as_word[1]
        rows: dict[str, list] = {n: [] for n in ("part", "keys", "sums", "ones", "twos", "more", "befores")}
        ranges = (ids // _U(RANGE)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(ranges, prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(ids))):
            rows["part"].append(int(ranges[a]))
            rows["keys"].append(pack(ids[a:b]))
            for name, values in zip(("sums", "ones", "twos", "more", "befores"), columns):
                rows[name].append(planes(values[a:b]))
        # The part's own sums travel in a row of their own, under a negative number.
        seen = np.bincount(np.minimum(counts, 5), minlength=6)[1:5].astype(np.int64)
        own = [-1 - part, planes(np.array([len(keys)], np.int64)), planes(seen), b"", b"", b"", b""]
        for name, value in zip(rows, own):
            rows[name].append(value)
        kinds_of = [pa.int32(), *[pa.binary()] * 6]
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(rows.items(), kinds_of)})

    pairs = docs.select("text").mapInArrow(count, _ROW).groupBy("part").applyInArrow(store, _STATS)
    pairs = staged(pairs, "kneser-ney-sums")
    pair_sizes, seen = [0] * (1 << bits), np.zeros(4, np.int64)
    for row in pairs.filter("part < 0").select("part", "keys", "sums").collect():
        pair_sizes[-1 - row["part"]] = int(from_planes(bytes(row["keys"]), np.int64)[0])
        seen += from_planes(bytes(row["sums"]), np.int64)

    def gather(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        dense = {name: np.zeros(RANGE, np.int64) for name in ("sums", "ones", "twos", "more", "befores")}
        for i, packed in enumerate(table.column("keys")):
            places = (unpack(packed.as_py()) - _U(part * RANGE)).astype(np.int64)
            for name, values in dense.items():
                values[places] += from_planes(table.column(name)[i].as_py(), np.int64)
        write_array(folder, f"context_sums-{part}", dense["sums"])
        write_array(folder, f"context_kinds-{part}", np.stack([dense["ones"], dense["twos"], dense["more"]], axis=1))
        write_array(folder, f"befores-{part}", dense["befores"])
        low = np.bincount(np.minimum(dense["befores"], 5), minlength=6)[1:6]
        return pa.table({"part": pa.array([part], pa.int32()), "low": pa.array([low.tolist()], pa.list_(pa.int64()))})

    low = np.zeros(5, np.int64)
    for row in pairs.filter("part >= 0").groupBy("part").applyInArrow(gather, "part int, low array<bigint>").collect():
        low += np.array(row["low"])
    total = sum(pair_sizes)
    d = _discounts(low[:4])
    taken = d[1] * low[0] + d[2] * low[1] + d[3] * low[2:].sum()
    return Model(
        folder, bits, sizes, tuple(pair_sizes), tokens, _discounts(seen), d, total, taken / total if total else 1.0
    )


def pair_keys(numbers: np.ndarray, starts: np.ndarray, start_of_text: int) -> np.ndarray:
    """Number of the word before (``start_of_text`` at the start) and of the word, in one key."""
    before = np.empty(len(numbers), np.int64)
    before[1:] = numbers[:-1]
    before[starts[:-1]] = start_of_text
    return (before.astype(np.uint64) << _U(32)) | numbers.astype(np.uint64)


class Scorer:
    """A worker's view of a model: memory-mapped arrays."""

    def __init__(self, model: Model):
        self.model = model
        self.words = Words(model.folder, model.bits, model.sizes)
        n = len(self.words)
        self.pairs = [map_array(model.folder, f"pairs-{k}", np.uint64) if s else np.empty(0, np.uint64) for k, s in enumerate(model.pair_sizes)]
        self.pair_counts = [map_array(model.folder, f"pair_counts-{k}", np.int64) if s else None for k, s in enumerate(model.pair_sizes)]
        # Number n is the start of a text.
        ranges = range(n // RANGE + 1) if n else ()
        self.sums = [map_array(model.folder, f"context_sums-{k}", np.int64) for k in ranges]
        self.kinds = [map_array(model.folder, f"context_kinds-{k}", np.int64).reshape(-1, 3) for k in ranges]
        self.befores = [map_array(model.folder, f"befores-{k}", np.int64) for k in ranges]

    def _take(self, files: list[np.ndarray], numbers: np.ndarray, width: int = 1) -> np.ndarray:
        out = np.zeros((len(numbers), width) if width > 1 else len(numbers), np.int64)
        for k, values in enumerate(files):
            own = np.flatnonzero(numbers // RANGE == k)
            out[own] = values[numbers[own] % RANGE]
        return out

    def log_probabilities(self, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 p of each token, given its number."""
        m, n = self.model, len(self.words)
        keys = pair_keys(numbers, starts, n)
        # A word never seen has number n too, but never the count of a pair or of words before it.
        after_unknown = np.zeros(len(numbers), bool)
        after_unknown[1:] = numbers[:-1] == n
        after_unknown[starts[:-1]] = False
        distinct, back = np.unique(mix(keys), return_inverse=True)
        counts = np.zeros(len(distinct), np.int64)
        for k, found, at in located(distinct, self.pairs, m.bits):
            counts[found] = self.pair_counts[k][at]
        counts = counts[back]
        counts[after_unknown | (numbers == n)] = 0
        words, where = np.unique(numbers, return_inverse=True)
        before = self._take(self.befores, words)
        before[words == n] = 0
        low = np.array(m.low_discounts)
        p0 = np.maximum(before - low[np.minimum(before, 3)], 0) / max(m.pairs, 1) + m.given_back / (n + 1)
        context = (keys >> _U(32)).astype(np.int64)
        contexts, which = np.unique(context, return_inverse=True)
        sums = self._take(self.sums, contexts)
        taken = self._take(self.kinds, contexts, 3) @ np.array(m.discounts[1:])
        back_off = np.where(sums > 0, taken / np.maximum(sums, 1), 1.0)[which]
        sums = sums[which]
        back_off[after_unknown], sums[after_unknown] = 1.0, 0
        high = np.maximum(counts - np.array(m.discounts)[np.minimum(counts, 3)], 0) / np.maximum(sums, 1)
        return np.log10(high + back_off * p0[where])


ADDED = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with token counts, a unigram base score and the model's score (log10) of each text."""
    added = T.StructType.fromDDL(ADDED)
    kept = docs.drop(*added.names)
    schema = T.StructType(kept.schema.fields + added.fields)
    names = schema.names

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        size = len(scorer.words)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                hashes, starts = with_ends(part.column("text"))
                numbers, counts = scorer.words.find(hashes)
                base = np.log10((counts + 0.5) / (model.tokens + 0.5 * (size + 1)))
                first = starts[:-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(np.diff(starts)),
                        pa.array(np.add.reduceat((counts > 0).astype(np.int64), first)),
                        pa.array(np.full(len(first), model.tokens, np.int64)),
                        pa.array(np.add.reduceat(base, first)),
                        pa.array(np.add.reduceat(scorer.log_probabilities(numbers, starts), first)),
                    ],
                    names=names,
                )

    return kept.mapInArrow(score, schema)
