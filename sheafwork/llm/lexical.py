"""Ranked lexical search: term partitions in a pipeline that item bundles travel through.

Terms are owned by stages, rarest terms first. A bundle carries the items of a group through the stages, with sparse
accumulators (document, integer score) for one block of documents; at each stage it meets by cogroup the
postings that stage owns of this block, adds their contributions, and goes on to the next owner. After the last
stage the best documents of every bundle are merged by a ranking window.

Between stages the scores so far give each item a threshold: its k-th best partial score. What the stages to
come can add at most to a document follows from the greatest contribution of each term. Accumulators that
can't reach the threshold any more are dropped, and no new ones are begun once a document without any earlier term
can't; this is exact, and what keeps frequent terms from filling the bundles.

Work is cut twice, so that no task holds the postings of a term or the accumulators of an item: documents lie in blocks
of ``BLOCK`` as they are read, and items in groups of some ``GROUP_TERMS`` terms and ``GROUP_ITEMS`` items. Only postings of the items' terms are
kept; the terms reach the readers as a bitmap of fixed size, in which a wrong hit costs a posting that
no item asks for and nothing else. Counts are taken over all documents.

Defined results: a null, empty or blank text has no term and is no candidate (it does not count in N); every row
is a document of its own, so repeated rows rank one after the other; rows without an id take no part, nor do items
without one; rows that share an item id are one item, whose terms count once; ties go to the smaller
doc_id; an item without a term in any document gives no rows; empty tables give an empty table; very long texts are
read whole; extra columns are ignored. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged
from .packed import from_planes, pack, planes, unpack
from .words import hash_ranges, slices, text_bytes

K = 50
# The ranking's fixed numbers.
_SATURATION, _LENGTH_PERCENT, _UNIT = 20, 50, 1_000_000_000
# A term is owned by the first stage whose share of the documents it does not exceed.
OWNERS = (0.001, 0.01, 0.1, 1.0)
BLOCK, GROUP_TERMS, GROUP_ITEMS = 4096, 8192, 256
# Bits of the bitmap of wanted terms: 2 ** 23 bits are a megabyte, whatever the number of items.
BITMAP_BITS = 23
# Groups whose terms are small enough to be broadcast to the blocks; more are joined by exchange.
BROADCAST_GROUPS = 16

_ALNUM = np.zeros(256, bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x41:0x5B] = _ALNUM[0x61:0x7B] = _ALNUM[0x80:] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[0x41:0x5B] += 32

_POSTINGS = "block bigint, term bigint, n bigint, docs binary, tf binary, length binary, words bigint"
_STATE = "block bigint, grp int, ids binary, terms binary, offsets binary, cells binary, best binary"


def batch_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of a batch of texts (as signed numbers), and the text each is in."""
    data, offsets = text_bytes(texts)
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    data = _SMALL[data]
    inside = _ALNUM[data]
    owner_starts = np.zeros(len(data) + 1, bool)
    owner_starts[offsets] = True
    before, after = np.append(False, inside[:-1]), np.append(inside[1:], False)
    starts = np.flatnonzero(inside & (~before | owner_starts[:-1]))
    ends = np.flatnonzero(inside & (~after | owner_starts[1:])) + 1
    owners = np.searchsorted(offsets, starts, side="right") - 1
    return hash_ranges(data, starts, ends).view(np.int64), owners


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``, each once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                terms, owners = batch_terms(part.column("text"))
                ids = part.column("item_id").take(pa.array(owners))
                yield pa.RecordBatch.from_arrays([ids, pa.array(terms)], names=["item_id", "term"])

    rows = items.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    return rows.mapInArrow(cut, "item_id bigint, term bigint").distinct()


def wanted_bitmap(terms: DataFrame) -> np.ndarray:
    """Bitmap over the leading bits of all terms, combined byte by byte before it reaches the driver."""
    bit = F.shiftrightunsigned("term", 64 - BITMAP_BITS)
    cells = terms.select(F.shiftright(bit, 3).alias("cell"), bit.bitwiseAND(F.lit(7)).cast("int").alias("bit"))
    filled = cells.groupBy("cell").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("bit"))).alias("value"))
    found = filled.toArrow()
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    bitmap[found.column("cell").to_numpy()] = found.column("value").to_numpy().astype(np.uint8)
    return bitmap


def posting_rows(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Documents in blocks as they are read: per block a row of its ids (``term`` null) and a row per wanted term."""

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        # Of the open block: ids, counts of terms, and keys (term, place) with their frequencies.
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0

        def block() -> pa.RecordBatch:
            nonlocal number, held
            length = np.concatenate(counts)
            terms, places, tf = (np.concatenate(parts) for parts in zip(*hits))
            order = np.lexsort((places, terms))
            terms, places, tf = terms[order], places[order], tf[order]
            firsts = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.empty(0, np.int64)
            ends = np.append(firsts[1:], len(terms))
            spans = [slice(a, b) for a, b in zip(firsts, ends)]
            rows = len(spans) + 1
            columns = [
                pa.array(np.full(rows, number)),
                pa.array([None, *terms[firsts].tolist()], pa.int64()),
                pa.array([int((length > 0).sum()), *(ends - firsts).tolist()], pa.int64()),
                pa.array([np.concatenate(ids).tobytes(), *[planes(places[s]) for s in spans]], pa.binary()),
                pa.array([None, *[planes(tf[s]) for s in spans]], pa.binary()),
                pa.array([None, *[planes(length[places[s]]) for s in spans]], pa.binary()),
                pa.array([int(length.sum()), *[None] * len(spans)], pa.int64()),
            ]
            ids.clear(), counts.clear(), hits.clear()
            number, held = number + 1, 0
            return pa.RecordBatch.from_arrays(columns, names=_names(_POSTINGS))

        for batch in batches:
            for part in slices(batch, "text"):
                at = 0
                while at < part.num_rows:
                    some = part.slice(at, BLOCK - held)
                    terms, owners = batch_terms(some.column("text"))
                    top = terms.view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
                    wanted = ((bitmap[top >> np.uint64(3)] >> (top & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
                    ids.append(some.column("doc_id").to_numpy())
                    counts.append(np.bincount(owners, minlength=some.num_rows))
                    hits.append(_frequencies(terms[wanted], owners[wanted] + held))
                    held += some.num_rows
                    at += some.num_rows
                    if held == BLOCK:
                        yield block()
        if held:
            yield block()

    rows = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(invert, _POSTINGS)


def _frequencies(terms: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (term, place) pairs and how often each occurs."""
    order = np.lexsort((places, terms))
    terms, places = terms[order], places[order]
    if not len(terms):
        return terms, places, places
    firsts = np.flatnonzero(np.append(True, (terms[1:] != terms[:-1]) | (places[1:] != places[:-1])))
    return terms[firsts], places[firsts], np.diff(np.append(firsts, len(terms)))


def impacts(tf: np.ndarray, length: np.ndarray, documents: int, words: int) -> np.ndarray:
    """What one occurrence list adds per unit of weight; whole numbers, rounded down twice as the ranking says."""
    norm = 100 - _LENGTH_PERCENT + (_LENGTH_PERCENT * length * documents) // words
    return (_UNIT * tf) // (1000 * tf + _SATURATION * norm)


def _posting(row_tf: bytes, row_length: bytes, documents: int, words: int) -> np.ndarray:
    return impacts(from_planes(row_tf, np.int64), from_planes(row_length, np.int64), documents, words)


def term_weight(documents: int, df: Column) -> Column:
    return F.floor(1000 * F.log(F.lit(float(2 * documents + 2)) / (2 * df + 1).cast("double"))).cast("bigint")


def _greatest(postings: DataFrame, documents: int, words: int) -> DataFrame:
    """Per posting row the greatest impact of its documents."""

    def greatest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("tf").to_pylist(), batch.column("length").to_pylist())
            top = [int(_posting(t, n, documents, words).max()) for t, n in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("term"), batch.column("n"), pa.array(top, pa.int64())], names=["term", "n", "top"])

    return postings.select("term", "n", "tf", "length").mapInArrow(greatest, "term bigint, n bigint, top bigint")


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


class Bundle:
    """Items of a group over one block of documents: what they ask for and what they have gathered."""

    def __init__(self, row: dict):
        self.row = row
        self.ids = np.frombuffer(row["ids"], np.int64)
        # Per (term, item): term, item, weight, greatest impact, owner; sorted by term.
        self.asked = np.frombuffer(row["terms"], np.int64).reshape(-1, 5)
        self.items = np.unique(self.asked[:, 1])
        self.slot = np.searchsorted(self.items, self.asked[:, 1])
        self.scores = np.zeros((len(self.items), len(self.ids)), np.int64)
        if row["cells"] is not None:
            self.scores.reshape(-1)[unpack(row["offsets"])] = from_planes(row["cells"], np.int64)

    def remaining(self, owner: int) -> np.ndarray:
        """Per item, the most that owners from ``owner`` on can add to a document."""
        later = self.asked[:, 4] >= owner
        return np.bincount(self.slot[later], (self.asked[:, 2] * self.asked[:, 3])[later].astype(np.float64), len(self.items))

    def advance(self, owner: int, postings: list[dict], thresholds: np.ndarray, documents: int, words: int) -> None:
        """Add what this owner's postings contribute, to documents that can still reach the threshold."""
        begun = self.scores > 0
        fresh = self.remaining(owner) >= thresholds
        terms = self.asked[:, 0]
        for posting in postings:
            lo, hi = np.searchsorted(terms, posting["term"], side="left"), np.searchsorted(terms, posting["term"], side="right")
            if lo == hi:
                continue
            places = from_planes(posting["docs"], np.int64)
            impact = _posting(posting["tf"], posting["length"], documents, words)
            for at in range(lo, hi):
                slot, weight = self.slot[at], self.asked[at, 2]
                if fresh[slot]:
                    self.scores[slot, places] += weight * impact
                else:
                    old = begun[slot, places]
                    self.scores[slot, places[old]] += weight * impact[old]

    def prune(self, owner: int, thresholds: np.ndarray, k: int) -> None:
        """Drop what can't be among the k best any more, by the threshold or by the block's own k-th score."""
        least = np.maximum(thresholds, self._own_thresholds(k))
        self.scores[self.scores + self.remaining(owner)[:, None] < least[:, None]] = 0

    def _own_thresholds(self, k: int) -> np.ndarray:
        n = self.scores.shape[1]
        if n < k:
            return np.zeros(len(self.items))
        return np.partition(self.scores, n - k, axis=1)[:, n - k].astype(np.float64)

    def best(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, document and score of the k best of each item; ties by document."""
        found = []
        for slot, item in enumerate(self.items):
            places = np.flatnonzero(self.scores[slot])
            values = self.scores[slot, places]
            first = np.lexsort((self.ids[places], -values))[:k]
            found.append((np.full(len(first), item), self.ids[places[first]], values[first]))
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3

    def state(self, k: int) -> dict:
        flat = self.scores.reshape(-1)
        cells = np.flatnonzero(flat)
        items, _, scores = self.best(k)
        best = np.stack([items, scores], axis=1) if len(items) else np.empty((0, 2), np.int64)
        return {**self.row, "offsets": pack(cells.astype(np.uint64)), "cells": planes(flat[cells]), "best": best.tobytes()}


def _stage(bundles: DataFrame, postings: DataFrame, owner: int, documents: int, words: int, k: int) -> DataFrame:
    """Bundles after their visit to one owner. ``limits`` holds (item, threshold) of the stages before."""

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.to_pylist()
        if not rows:
            return pa.Table.from_pylist([], schema)
        bundle = Bundle(rows[0])
        limits = np.frombuffer(rows[0].get("limits") or b"", np.int64).reshape(-1, 2)
        thresholds = np.zeros(len(bundle.items))
        thresholds[np.searchsorted(bundle.items, limits[:, 0])] = limits[:, 1]
        bundle.prune(owner, thresholds, k)
        bundle.advance(owner, right.to_pylist(), thresholds, documents, words)
        bundle.prune(owner + 1, thresholds, k)
        state = bundle.state(k)
        return pa.Table.from_pylist([{c: state[c] for c in schema.names}], schema)

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in _STATE.split(", ")])
    own = postings.filter(F.col("owner") == owner).select("block", "grp", "term", "docs", "tf", "length")
    left, right = bundles.groupBy("block", "grp"), own.groupBy("block", "grp")
    return staged(left.cogroup(right).applyInArrow(visit, _STATE), f"bundles-{owner}")


def _scores(bundles: DataFrame) -> DataFrame:
    """``grp, item_id, score`` of the best partial scores of every bundle."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, best in zip(batch.column("grp").to_pylist(), batch.column("best").to_pylist()):
                pairs = np.frombuffer(best, np.int64).reshape(-1, 2)
                columns = [pa.array(np.full(len(pairs), grp, np.int32)), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]
                yield pa.RecordBatch.from_arrays(columns, names=["grp", "item_id", "score"])

    return bundles.select("grp", "best").mapInArrow(unpack, "grp int, item_id bigint, score bigint")


def _by_group(bundles: DataFrame, packed: DataFrame, groups: int) -> DataFrame:
    """Each bundle with the packed row of its group: few groups are broadcast, many spread the join by themselves."""
    return bundles.join(F.broadcast(packed) if groups <= BROADCAST_GROUPS else packed, "grp", "left")


def _limits(bundles: DataFrame, k: int) -> DataFrame:
    """``grp, limits``: per item with k scores so far the k-th of them, packed by group."""
    best = Window.partitionBy("grp", "item_id").orderBy(F.col("score").desc())
    kth = _scores(bundles).withColumn("place", F.row_number().over(best)).filter(F.col("place") == k)
    return _packed_by_group(kth, "item_id", "score").withColumnRenamed("packed", "limits")


def _packed_by_group(rows: DataFrame, *names: str) -> DataFrame:
    """``grp, packed``: the rows of a group as one array of 64-bit numbers, in order."""

    def pack(table: pa.Table) -> pa.Table:
        matrix = np.stack([table.column(c).to_numpy().astype(np.int64) for c in names], axis=1)
        matrix = matrix[np.lexsort(matrix.T[::-1])]
        return pa.table({"grp": table.column("grp")[:1].cast(pa.int32()), "packed": [matrix.tobytes()]})

    return rows.select("grp", *names).groupBy("grp").applyInArrow(pack, "grp int, packed binary")


def ranked(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of each item's k best documents with a score above 0."""
    asked = staged(item_terms(items), "item-terms")
    postings = staged(posting_rows(docs, wanted_bitmap(asked)), "postings")
    heads, lists = postings.filter(F.col("term").isNull()), postings.filter(F.col("term").isNotNull())
    total = heads.agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    documents, words = int(total["n"] or 0), int(total["words"] or 0)

    # A group has some GROUP_TERMS terms of GROUP_ITEMS items at most, or one item with more terms.
    size = asked.agg(F.count("*").alias("terms"), F.count_distinct("item_id").alias("items")).first()
    groups = max(1, -(-size["terms"] // GROUP_TERMS), -(-size["items"] // GROUP_ITEMS))
    counted = _greatest(lists, documents, max(1, words)).groupBy("term").agg(F.sum("n").alias("df"), F.max("top").alias("top"))
    owner = F.lit(len(OWNERS) - 1)
    for stage in range(len(OWNERS) - 2, -1, -1):
        owner = F.when(F.col("df") <= OWNERS[stage] * documents, stage).otherwise(owner)
    grouped = asked.withColumn("grp", F.pmod(F.xxhash64("item_id"), F.lit(groups)).cast("int"))
    weighed = staged(
        grouped.join(counted, "term").select("grp", "item_id", "term", term_weight(documents, F.col("df")).alias("weight"), "top", owner.alias("owner")),
        "weighed-terms",
    )

    # What a group asks for; sorted by term inside a bundle.
    packed = staged(_packed_by_group(weighed, "term", "item_id", "weight", "top", "owner"), "group-terms")
    numbers = heads.select("block", F.col("docs").alias("ids"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"))
    empty = F.lit(None).cast("binary")
    bundles = _by_group(numbers, packed.withColumnRenamed("packed", "terms"), groups).filter(
        F.col("terms").isNotNull()
    ).select("block", "grp", "ids", "terms", *[empty.alias(c) for c in ("offsets", "cells", "best")])
    wanted = weighed.select("term", "grp", "owner").distinct()
    owned = staged(lists.join(wanted, "term").select("block", "grp", "owner", "term", "docs", "tf", "length"), "owned-postings")

    for stage in range(len(OWNERS)):
        if stage:
            bundles = _by_group(bundles, staged(_limits(bundles, k), "limits"), groups)
        bundles = _stage(bundles, owned, stage, documents, max(1, words), k)
    return _final(bundles, k)


def _final(bundles: DataFrame, k: int) -> DataFrame:
    def best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bundle = Bundle({name: batch.column(name)[row].as_py() for name in batch.schema.names})
                columns = [pa.array(c, pa.int64()) for c in bundle.best(k)]
                yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score"])

    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    rows = bundles.select("ids", "terms", "offsets", "cells").mapInArrow(best_of, "item_id bigint, doc_id bigint, score bigint")
    return rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
