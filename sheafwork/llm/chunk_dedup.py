"""Substring dedup by content-defined chunking.

A gear rolling hash runs over the bytes of a text; a chunk ends where ``BITS`` bits of it are zero, but not
before ``SMALLEST`` bytes and at ``LARGEST`` at the latest. The hash sees the last 16 bytes alone, so
after an insertion the chunks of what follows are soon cut as before. Chunks are deduplicated by digest:
the first (least doc_id, then position) stays, every other is a repeat, and neighbouring repeats of a
text are joined into spans of ``LEAST`` bytes or more.

The first occurrence of a digest is a minimum added up before the exchange, so a chunk that a third of
all documents hold has one entry per task there; its occurrences are spread when they are joined.

Defined results: null and empty texts have no spans; chunks end between characters; rows without doc_id
are left alone and are no originals; digests have 64 bits; rows that repeat id and text are one document; an id with several
texts is several documents, whose originals are told apart by position only; a text may repeat itself;
very long texts are read whole; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import staged
from .spans import joined_spans
from .words import hash_ranges, mix, slices, text_bytes

SMALLEST, LARGEST, BITS = 16, 128, 4
LEAST = 64
SLICE = 1 << 22
_GEAR = (mix(np.arange(256, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)
# The highest bits of 16 have seen all of the last 16 bytes.
_MASK = np.uint16(((1 << BITS) - 1) << (16 - BITS))
_CHUNK = "digest bigint, doc_id bigint, mark bigint, start int, size int, fresh boolean"


def gear(data: np.ndarray) -> np.ndarray:
    """Rolling hash at every byte: the sum of the gears of the last 16 bytes, each shifted by its age."""
    h, step = _GEAR[data], 1
    while step < 16:
        older = np.zeros_like(h)
        older[step:] = h[:-step] << np.uint16(step)
        h, step = h + older, step * 2
    return h


def cuts(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Borders of the chunks of each text, first and last byte's included, in bytes of the batch."""
    fits = np.ones(len(data) + 1, bool)
    fits[:-1] = (data & 0xC0) != 0x80
    candidates = np.flatnonzero((gear(data) & _MASK) == 0) + 1
    candidates = candidates[fits[candidates]]
    borders = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        own = candidates[np.searchsorted(candidates, a) : np.searchsorted(candidates, b)].tolist()
        found, last = [a], a
        for c in [*own, b]:
            while c - last > LARGEST:
                last += LARGEST
                while not fits[last]:
                    last += 1
                found.append(last)
            if c - last >= SMALLEST or (c == b and c > last):
                found.append(c)
                last = c
        borders.append(found)
    return borders


def chunks(docs: DataFrame) -> DataFrame:
    """``digest``, ``doc_id``, ``mark``, ``start``, ``size`` (bytes), and ``fresh``: not in the text before."""
    named = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    marked = named.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                data, offsets = text_bytes(piece.column("text"))
                borders = cuts(data, offsets)
                owner = np.repeat(np.arange(len(borders)), [len(x) - 1 for x in borders])
                starts = np.array([c for x in borders for c in x[:-1]], np.int64)
                ends = np.array([c for x in borders for c in x[1:]], np.int64)
                digests = hash_ranges(data, starts, ends).view(np.int64)
                order = np.lexsort((starts, digests, owner))
                again = np.zeros(len(owner), bool)
                again[order[1:]] = (owner[order[1:]] == owner[order[:-1]]) & (digests[order[1:]] == digests[order[:-1]])
                take = pa.array(owner, pa.int64())
                columns = [
                    pa.array(digests),
                    piece.column("doc_id").take(take),
                    piece.column("mark").take(take),
                    pa.array((starts - offsets[owner]).astype(np.int32)),
                    pa.array((ends - starts).astype(np.int32)),
                    pa.array(~again),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["digest", "doc_id", "mark", "start", "size", "fresh"])

    return marked.mapInArrow(cut, _CHUNK)


def repeated_spans(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id``, ``mark`` (hash of the text), ``spans``: start and end in bytes, and the original."""
    cut = chunks(docs)
    fresh = F.col("fresh")
    firsts = cut.groupBy("digest").agg(
        F.count("*").alias("n"),
        F.min("doc_id").alias("first_doc_id"),
        F.min_by(F.when(fresh, F.col("start")), F.when(fresh, F.col("doc_id"))).alias("first_start"),
    )
    repeated = staged(firsts.filter("n > 1").drop("n"), "repeated-chunks")
    repeats = cut.join(repeated, "digest").filter("NOT (doc_id = first_doc_id AND start = first_start)")
    matches = repeats.select("doc_id", "mark", "start", (F.col("start") + F.col("size")).alias("end"), "first_doc_id")
    return joined_spans(matches.distinct(), least)
