"""Repeated passages by hash groups of sparse suffixes, in place of a suffix array.

No suffix is sorted and no neighbours are compared: the first words of kept suffixes are grouped by hash.

Of a text's suffixes (from word to word) only those at minimiser positions are kept: where the hash of
the next ``KEY`` words is the least among ``SPAN`` neighbouring positions. That depends on the words around
alone, so a passage of ``LEAST`` words or more has a kept position inside, with at least ``BEFORE`` words of
the passage before it and ``AFTER`` from it on, and has it wherever it occurs. These ``CORE`` words are what kept
suffixes are grouped by: those of one hash are occurrences of one core, and the first (least
doc_id, then position) is the original. Every other occurrence is extended left and right, word by
word, as far as it agrees with the original, and overlapping matches of a document are joined into spans.

A core is compared with its first occurrence, found by a minimum that is added up before the exchange, so a
passage that a third of all documents share has one entry per task there, and its occurrences are
spread when they are joined with it. Extension is needed at most ``REACH`` words beyond a core, and only
at the ends of a run of cores: what lies between is covered by cores.

Guarantee: a passage of ``LEAST`` words or more that occurs before is found whole where its cores' first
occurrences have all of it, too. Where those have just a part, later whole copies are compared with that part
only: the span is cut short, and left out when under ``LEAST`` words agree. A span is reported from ``LEAST`` words on; each of its words
lies in a run of ``CORE`` words or more that occurs before.

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
from .words import batch_words, gram_hashes, mix, slices, text_bytes, word_bounds

LEAST, KEY, SPAN = 50, 8, 21
BEFORE = (LEAST - SPAN - KEY + 1) // 2
AFTER = LEAST - BEFORE - SPAN + 1
CORE = BEFORE + AFTER
REACH = SPAN - 1
SLICE = 1 << 20
_BYTES = 3
_U = np.uint64


def kept_positions(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minimiser positions whose core lies inside its text, over a batch of texts."""
    keys = gram_hashes(words, KEY)
    if len(keys) < SPAN:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(keys, SPAN)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    whole = text[: len(windows)] == text[SPAN + KEY - 2 : SPAN + KEY - 2 + len(windows)]
    at = np.flatnonzero(whole)
    if not len(at):
        return at
    chosen = np.unique(at + windows[at].argmin(axis=1))
    first, end = starts[text[chosen]], starts[text[chosen] + 1]
    return chosen[(chosen - BEFORE >= first) & (chosen + AFTER <= end)]


def core_hashes(words: np.ndarray, positions: np.ndarray) -> np.ndarray:
    h = np.zeros(len(positions), np.uint64)
    for k in range(-BEFORE, AFTER):
        h = mix(h * _U(0x100000001B3) + words[positions + k])
    return h.view(np.int64)


def cores(docs: DataFrame) -> DataFrame:
    """``core``, ``doc_id``, ``mark``, ``pos`` of every kept suffix; ``fresh`` if its text has none before."""

    @over_batches
    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                words, starts = batch_words(piece.column("text"), lower=False)
                positions = kept_positions(words, starts)
                hashes = core_hashes(words, positions)
                owner = np.searchsorted(starts, positions, side="right") - 1
                order = np.lexsort((positions, hashes, owner))
                again = np.zeros(len(positions), bool)
                again[order[1:]] = (owner[order[1:]] == owner[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes),
                        piece.column("doc_id").take(pa.array(owner)),
                        piece.column("mark").take(pa.array(owner)),
                        pa.array((positions - starts[owner]).astype(np.int32)),
                        pa.array(~again),
                    ],
                    names=["core", "doc_id", "mark", "pos", "fresh"],
                )

    return docs.mapInArrow(sparse, "core bigint, doc_id bigint, mark bigint, pos int, fresh boolean")


def _marked(docs: DataFrame) -> DataFrame:
    named = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return named.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")


def matches(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``mark``, ``start``, ``end`` (words), ``first_doc_id`` of every extended match."""
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
    place = F.struct("pos", "core", "mark", "first_doc_id", "original")
    per_text = occurrences.groupBy("doc_id").agg(F.collect_list(place).alias("places"))
    found = staged(marked.join(per_text, "doc_id").mapInArrow(_with_surroundings, _SURROUNDED), "surroundings")
    sides = found.filter("original").select("core", F.col("left").alias("l"), F.col("right").alias("r"))
    # Rows that repeat id and text give one original several times.
    sides = sides.dropDuplicates(["core"])
    others = found.filter("NOT original").drop("original")
    return others.join(staged(sides, "originals"), "core", "left").mapInArrow(_extended, _MATCH).distinct()


_SURROUNDED = "core bigint, doc_id bigint, mark bigint, pos int, first_doc_id bigint, original boolean, left binary, right binary"
_MATCH = "doc_id bigint, mark bigint, start int, end int, first_doc_id bigint"


def _with_surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words around cores: of originals on both sides, of others where a run of cores begins or ends."""
    for batch in batches:
        for piece in slices(batch, "text", SLICE):
            words, starts = batch_words(piece.column("text"), lower=False)
            small = np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)[:, :_BYTES]
            rows: dict[str, list] = {n: [] for n in ("core", "doc_id", "mark", "pos", "first_doc_id", "original", "left", "right")}
            ids, marks, lists = (piece.column(c).to_pylist() for c in ("doc_id", "mark", "places"))
            for i, places in enumerate(lists):
                own = small[starts[i] : starts[i + 1]]
                here = sorted((p for p in places if p["mark"] == marks[i]), key=lambda p: p["pos"])
                later = [p["pos"] for p in here if not p["original"]]
                before = dict(zip(later[1:], later))
                after = dict(zip(later, later[1:]))
                for p in here:
                    pos = p["pos"]
                    begins = p["original"] or pos - before.get(pos, -CORE - 1) > CORE
                    ends = p["original"] or after.get(pos, pos + CORE + 1) - pos > CORE
                    a, b = pos - BEFORE, pos + AFTER
                    rows["left"].append(own[max(0, a - REACH) : a][::-1].tobytes() if begins else b"")
                    rows["right"].append(own[b : b + REACH].tobytes() if ends else b"")
                    for name in ("core", "pos", "first_doc_id", "original"):
                        rows[name].append(p[name])
                    rows["doc_id"].append(ids[i])
                    rows["mark"].append(marks[i])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=list(rows))


def _agreeing(ours: bytes | None, theirs: bytes | None) -> int:
    """Number of words two surroundings begin with in common."""
    n = min(len(ours or b""), len(theirs or b"")) // _BYTES
    k = 0
    while k < n and ours[k * _BYTES : (k + 1) * _BYTES] == theirs[k * _BYTES : (k + 1) * _BYTES]:
        k += 1
    return k


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ours = [batch.column(c).to_pylist() for c in ("left", "l", "right", "r")]
        lefts = [_agreeing(a, b) for a, b in zip(ours[0], ours[1])]
        rights = [_agreeing(a, b) for a, b in zip(ours[2], ours[3])]
        pos = batch.column("pos").to_numpy()
        starts, ends = pos - BEFORE - np.array(lefts, np.int32), pos + AFTER + np.array(rights, np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("mark"),
                pa.array(starts.astype(np.int32)),
                pa.array(ends.astype(np.int32)),
                batch.column("first_doc_id"),
            ],
            names=["doc_id", "mark", "start", "end", "first_doc_id"],
        )


def repeated_spans(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id``, ``mark`` (hash of the text), ``spans``: start and end in words, and the original."""
    return joined_spans(matches(docs), least)


def without_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` without the words of repeated spans; a text that has no word left goes.

    Texts without spans stay as they are, to the byte, and so do rows without id or text.
    """
    return without_spans(docs, repeated_spans(docs, least))


def without_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the words of ``found``: ``doc_id``, ``mark``, ``spans`` as ``repeated_spans`` gives them."""
    # Columns are numbered while they travel, so that none can clash with the operator's own.
    own, place = docs.columns, docs.columns.index("text")
    names = [f"c{i}" for i in range(len(own))]
    numbered = docs.toDF(*names)
    doc, text = f"c{own.index('doc_id')}", f"c{place}"
    spans = staged(found, "spans").select("doc_id", "mark", "spans")
    # Only rows that may have spans are exchanged.
    named = F.xxhash64(F.col(doc).cast("bigint"), F.xxhash64(text))
    doubtful, sure = told_apart(numbered, named, spans.select(F.xxhash64("doc_id", "mark")))
    rows = doubtful.join(spans, (F.col(doc) == F.col("doc_id")) & (F.xxhash64(text) == F.col("mark")), "left")
    untouched = sure.unionByName(rows.filter("spans IS NULL").select(*names))
    touched = rows.filter("spans IS NOT NULL").drop("doc_id", "mark")

    @over_batches
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text, SLICE):
                data, offsets = text_bytes(piece.column(text))
                texts, kept = [], []
                for i, spans in enumerate(piece.column("spans").to_pylist()):
                    own = data[offsets[i] : offsets[i + 1]]
                    starts, _ = word_bounds(own, np.array([0, len(own)]))
                    edges, at, parts = np.append(starts, len(own)), 0, []
                    for span in spans:
                        parts.append(own[at : edges[span["start"]]])
                        at = edges[span["end"]]
                    left = np.concatenate([*parts, own[at:]])
                    if len(word_bounds(left, np.array([0, len(left)]))[0]):
                        texts.append(left.tobytes().decode())
                        kept.append(i)
                out = piece.select(names).take(pa.array(kept, pa.int64()))
                columns = [*out.columns[:place], pa.array(texts, pa.string()), *out.columns[place + 1 :]]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return untouched.unionByName(touched.mapInArrow(cut, numbered.schema)).toDF(*own)
