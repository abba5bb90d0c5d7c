"""Repeated passages by a sparse suffix array: kept suffixes are sorted and compared with their neighbours.

Of a text's suffixes (from word to word) only those at minimiser positions are kept: where the hash of
the next ``KEY`` words is the least among ``SPAN`` neighbouring positions. That depends on the words around
alone, so a passage of ``LEAST`` words or more has a kept position inside, with at least ``BEFORE`` words of
the passage before it and ``AFTER`` from it on, and has it wherever it occurs. A suffix is kept from ``BEFORE``
words before that position on; its first ``CORE`` words are compared as one hash, the next ``REACH`` word by word.

Suffixes whose core occurs once can't lie in a repeat and drop out by a count that is added up before
its exchange. The others are sorted by a range exchange: by core and the words after it, and once more by core
and the words before it, read backwards. In either order the agreement of each row with the one before it is
the array of longest common prefixes; rows that agree on the core and k more words are a run of it, and a row is
extended by the most words whose run holds an earlier occurrence (smaller doc_id, then position). So every
occurrence is compared with all earlier ones, not just with the first, as the hash groups of ``suffix_dedup`` do. Overlapping matches of a document are
joined into spans. ``REACH`` words beyond a core are enough: what lies between cores of a run is covered by them.

A partition holds ``ROWS`` suffixes or so, measured before it is cut. Doc_id and position are part of the sort
key, so a passage that a third of all documents share is cut like any other rows: a partition tells the least
occurrence of the runs its first and its last row lie in, at most 2 * (``REACH`` + 1) rows a partition, and the
rows of those two cores are settled with the least of all partitions.

Guarantee: a passage of ``LEAST`` words or more that occurs before is found whole, whatever other documents hold
parts of it. A span is reported from ``LEAST`` words on; each of its words lies in a run of ``CORE`` words or
more that occurs before, neighbouring runs maybe in different documents. ``first_doc_id`` is the least document
that holds one of a span's cores.

Defined results: null, empty and short texts have no spans; rows without doc_id are left alone and are no
originals; rows that repeat id and text are one document; an id with several texts is several documents,
whose originals are told apart by position only; a text may repeat itself; very long texts are read
whole; an empty table gives an empty table; extra columns stay as they are. Words are compared by
hashes, 64 bits in cores and 24 bits in extensions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import staged
from .frugal import over_batches
from .presence import told_apart
from .spans import joined_spans
from .suffix_dedup import AFTER, BEFORE, CORE, LEAST, REACH, SLICE, cores, without_spans
from .words import batch_words, mix, slices

# Suffixes of a sorted partition; bounds a task's memory, not the result.
ROWS = 200_000
_BYTES = 3
_U = np.uint64


def _marked(docs: DataFrame) -> DataFrame:
    named = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return named.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")


def matches(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``mark``, ``start``, ``end`` (words), ``first_doc_id`` of every extended match."""
    spark = docs.sparkSession
    marked = _marked(docs)
    kept = cores(marked)
    fresh = F.col("fresh")
    firsts = kept.groupBy("core").agg(
        F.count("*").alias("n"),
        F.min("doc_id").alias("first_doc_id"),
        F.min_by(F.when(fresh, F.col("pos")), F.when(fresh, F.col("doc_id"))).alias("first_pos"),
    )
    repeated = staged(firsts.filter("n > 1").drop("n"), "repeated-cores")
    original = (F.col("doc_id") == F.col("first_doc_id")) & (F.col("pos") == F.col("first_pos"))
    # Occurrences of one core are spread over tasks where they are many: both sides come from files
    # or texts, and Spark splits what is skewed.
    occurrences = kept.join(repeated, "core").select("core", "doc_id", "mark", "pos", "first_doc_id", original.alias("original"))
    place = F.struct("pos", "core", "first_doc_id", "original")
    per_text = staged(occurrences.groupBy("doc_id", "mark").agg(F.collect_set(place).alias("places")), "places")
    # Texts without a repeated core are not exchanged.
    named = F.xxhash64("doc_id", "mark")
    texts, _ = told_apart(marked, named, per_text.select(named))
    # Rows that repeat id and text give the same suffixes, which are equal rows in either order.
    found = staged(texts.join(per_text, ["doc_id", "mark"]).mapInArrow(_with_surroundings, _SURROUNDED), "surroundings")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-found.count() // ROWS))
    sides = [
        extended(found.select(*_PLACE, F.lit(True).alias("asked"), F.col("left").alias("side")), parts).select(
            "doc_id", "mark", (F.col("pos") - BEFORE - F.col("more")).alias("start"), (F.col("pos") + AFTER).alias("end"), "first_doc_id"
        ),
        extended(found.select(*_PLACE, F.col("ends").alias("asked"), F.col("right").alias("side")), parts).select(
            "doc_id", "mark", (F.col("pos") - BEFORE).alias("start"), (F.col("pos") + AFTER + F.col("more")).alias("end"), "first_doc_id"
        ),
    ]
    return sides[0].unionByName(sides[1]).distinct()


_PLACE = ("core", "doc_id", "mark", "pos", "first_doc_id")
_SURROUNDED = "core bigint, doc_id bigint, mark bigint, pos int, first_doc_id bigint, ends boolean, left binary, right binary"
_SETTLED = "kind int, core bigint, doc_id bigint, mark bigint, pos int, first_doc_id bigint, asked boolean, side binary, more int"
_KINDS = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.int32())
# Kinds of rows a sorted partition gives: a match, a suffix whose core may go on elsewhere, a run at the border.
MATCH, OPEN, BORDER = 0, 1, 2


@over_batches
def _with_surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words around every occurrence of a repeated core; ``ends``: no later occurrence touches it on the right."""
    for batch in batches:
        for piece in slices(batch, "text", SLICE):
            words, starts = batch_words(piece.column("text"), lower=False)
            small = np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)[:, :_BYTES]
            rows: dict[str, list] = {n: [] for n in ("core", "doc_id", "mark", "pos", "first_doc_id", "ends", "left", "right")}
            ids, marks, lists = (piece.column(c).to_pylist() for c in ("doc_id", "mark", "places"))
            for i, places in enumerate(lists):
                own = small[starts[i] : starts[i + 1]]
                here = sorted(places, key=lambda p: p["pos"])
                later = [p["pos"] for p in here if not p["original"]]
                after = dict(zip(later, later[1:]))
                for p in here:
                    pos = p["pos"]
                    a, b = pos - BEFORE, pos + AFTER
                    rows["left"].append(own[max(0, a - REACH) : a][::-1].tobytes())
                    rows["right"].append(own[b : b + REACH].tobytes())
                    rows["ends"].append(after.get(pos, pos + CORE + 1) - pos > CORE)
                    for name in ("core", "pos", "first_doc_id"):
                        rows[name].append(p[name])
                    rows["doc_id"].append(ids[i])
                    rows["mark"].append(marks[i])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=list(rows))


def side_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words beside cores, ``REACH`` a row (0 where there are fewer), and how many there are."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.diff(offsets) // _BYTES
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].reshape(-1, _BYTES).astype(np.uint32)
    out = np.zeros((len(held), REACH), np.uint32)
    out[np.arange(REACH) < held[:, None]] = data[:, 0] | (data[:, 1] << 8) | (data[:, 2] << 16)
    return out, held


def run_hashes(core: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """Hash of core and the next k words, for k from 0 to ``REACH``; a column for each."""
    hashes = [mix(core.view(np.uint64))]
    for k in range(REACH):
        hashes.append(mix(hashes[-1] * _U(0x100000001B3) + beside[:, k].astype(np.uint64)))
    return np.stack(hashes, axis=1)


def run_minima(core: np.ndarray, beside: np.ndarray, held: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Over sorted rows: per number of words the least rank in a row's run, and the most words with an earlier row
    (-1: none earlier has the core)."""
    agree = (beside[1:] == beside[:-1]) & (np.arange(REACH) < np.minimum(held[1:], held[:-1])[:, None])
    common = np.where(core[1:] == core[:-1], np.logical_and.accumulate(agree, axis=1).sum(axis=1), -1)
    least = np.empty((len(core), REACH + 1), rank.dtype)
    more = np.full(len(core), -1, np.int32)
    for k in range(REACH + 1):
        first = np.flatnonzero(np.concatenate([[True], common < k]))
        least[:, k] = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(core))))
        more[(least[:, k] < rank) & (held >= k)] = k
    return least, more


@over_batches
def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition's matches, the suffixes of its first and last core, and the runs at its borders."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
    core, doc_id, pos = (table.column(c).to_numpy() for c in ("core", "doc_id", "pos"))
    beside, held = side_words(table.column("side"))
    order = np.lexsort((pos, doc_id))
    differs = (np.diff(doc_id[order]) != 0) | (np.diff(pos[order]) != 0)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.concatenate([[0], np.cumsum(differs)])
    least, more = run_minima(core, beside, held, rank)
    at_border = (core == core[0]) | (core == core[-1])
    for kind, own in ((MATCH, ~at_border & (more >= 0) & table.column("asked").to_numpy(zero_copy_only=False)), (OPEN, at_border)):
        taken = table.take(pa.array(np.flatnonzero(own)))
        columns = {name: taken.column(name) for name in taken.schema.names}
        columns |= {"kind": pa.array(np.full(len(taken), kind, np.int32)), "more": pa.array(more[own])}
        if kind == MATCH:
            columns["side"] = pa.nulls(len(taken), pa.binary())
        names = [f.split()[0] for f in _SETTLED.split(", ")]
        yield pa.RecordBatch.from_arrays([columns[n].cast(t) for n, t in zip(names, _KINDS)], names=names)
    where = order[np.searchsorted(rank[order], np.arange(rank.max() + 1))]
    border = []
    for row in {0, len(core) - 1}:
        hashes = run_hashes(core[row : row + 1], beside[row : row + 1]).view(np.int64)[0]
        for k in range(held[row] + 1):
            first = where[least[row, k]]
            border.append((BORDER, int(hashes[k]), int(doc_id[first]), None, int(pos[first]), None, None, None, None))
    names = [f.split()[0] for f in _SETTLED.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*border), _KINDS)], names=names)


def extended(suffixes: DataFrame, parts: int) -> DataFrame:
    """``suffixes`` that occur before, with ``more``: how many words beside the core agree, too."""
    key = ("core", "side", "doc_id", "pos", "mark")
    ordered = suffixes.repartitionByRange(parts, *key).sortWithinPartitions(*key)
    settled = staged(ordered.mapInArrow(_settled, _SETTLED), "sorted-suffixes")
    # Two rows a partition, a row for each number of words.
    runs = settled.filter(F.col("kind") == BORDER).groupBy("core").agg(F.min(F.struct("doc_id", "pos")).alias("least")).collect()
    runs.sort(key=lambda r: r["core"])
    hashes = np.array([r["core"] for r in runs], np.int64)
    docs, places = np.array([r["least"]["doc_id"] for r in runs], np.int64), np.array([r["least"]["pos"] for r in runs], np.int64)

    @over_batches
    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            doc_id, pos = batch.column("doc_id").to_numpy(), batch.column("pos").to_numpy()
            beside, held = side_words(batch.column("side"))
            more = batch.column("more").to_numpy().copy()
            for k, own in enumerate(run_hashes(batch.column("core").to_numpy(), beside).view(np.int64).T):
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                earlier = (docs[at] < doc_id) | ((docs[at] == doc_id) & (places[at] < pos))
                more[(hashes[at] == own) & earlier & (held >= k) & (more < k)] = k
            out = batch.set_column(batch.schema.get_field_index("more"), "more", pa.array(more, pa.int32()))
            yield out.filter(pa.array(more >= 0))

    # Matches hold no side words and their cores lie at no border: they go through as they are, in the same pass.
    return settled.filter((F.col("kind") != BORDER) & F.col("asked")).mapInArrow(settle, _SETTLED).select(*_PLACE, "more")


def repeated_spans(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id``, ``mark`` (hash of the text), ``spans``: start and end in words, and the original."""
    return joined_spans(matches(docs), least)


def without_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` without the words of repeated spans; a text that has no word left goes.

    Texts without spans stay as they are, to the byte, and so do rows without id or text.
    """
    return without_spans(docs, repeated_spans(docs, least))
