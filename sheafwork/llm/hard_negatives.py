"""Hard-negative mining: branch and bound on vertically decomposed vectors (BOND).

Vectors lie in blocks of ``BLOCK`` rows, dimension by dimension, each dimension with its least and greatest
value in the block. For an anchor a block is read a few dimensions at a time, in descending order of the anchor's
own magnitudes: partial inner products grow, and what the unread dimensions can still add at least and at
most follows from their extremes. A bitmap holds the rows that can still matter; it shrinks until the bounds meet.

1. Positives: of the rows with the anchor's label, those whose upper bound is under the k-th lower bound go.
2. Negatives: every (anchor, positive) is a window of scores. Of the rows with another label, those go that can no
   longer lie in any window, or that ``most`` rows surely inside each window they can still reach surely precede.

Blocks stay where they are; anchors travel to them, ``PACK`` to a row, as a stream, so a task holds one block
and one batch of anchors. Per block the few rows that count are returned and merged by a ranking window.
The anchors are a stated query set against all rows, so the work is anchors times rows.

Defined results: rows with a null id, label or vector, an empty vector, or a null or non-finite component take no
part; vectors of different dimensions never meet; rows with the anchor's id are neither its positives nor its
negatives; repeated rows are rows of their own, and an id with several anchor rows is searched once, by its
least (label, vector); ties go to the smaller id; a window that holds nothing gives no rows; an empty table
gives an empty table; extra columns are ignored. Scores must fit into 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
# A negative's score lies between these hundredths of its positive's.
LEAST_PERCENT, MOST_PERCENT = 30, 90
BLOCK, PACK = 8192, 64
# Dimensions read between two looks at the bounds.
STRIDE = 8
# Keys that block numbers of one dimension count are spread over before they meet the anchors.
_SPREAD = 16

_BLOCKS = "block bigint, dim int, ids binary, labels binary, columns binary"
_PACKS = "pack bigint, dim int, anchors binary, labels binary, vectors binary, positives binary"


def integer_rows(embeddings: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label``, ``v`` (floor of scale times each component) and ``dim`` of usable rows."""
    wide = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("_w", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), wide.alias("_w")
    )
    known = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("_w") > 0))
    usable = known.filter(F.coalesce(finite, F.lit(False)))
    whole = F.transform("_w", lambda x: F.floor(x * scale).cast("bigint"))
    return usable.select("vec_id", "label", whole.alias("v"), F.size("_w").alias("dim"))


def vertical_blocks(rows: DataFrame) -> DataFrame:
    """Rows in blocks of one dimension count, as they are read: no exchange."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, labels, matrix = (np.concatenate(parts) for parts in zip(*held.pop(dim)))
            number += 1
            values = [number - 1, dim, ids.tobytes(), labels.tobytes(), narrow(matrix.T)]
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds)], names=["block", "dim", "ids", "labels", "columns"]
            )

        for batch in batches:
            for dim, part in by_dimension(batch):
                at = 0
                while at < len(part[0]):
                    have = sum(len(p[0]) for p in held.get(dim, ()))
                    end = min(len(part[0]), at + BLOCK - have)
                    held.setdefault(dim, []).append(tuple(p[at:end] for p in part))
                    if have + end - at == BLOCK:
                        yield block(dim)
                    at = end
        for dim in sorted(held):
            yield block(dim)

    return staged(rows.mapInArrow(packed, _BLOCKS), "vertical-blocks")


def by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Per dimension count: ids, labels and the matrix of the batch's rows."""
    dims = batch.column("dim").to_numpy()
    values, offsets = batch.column("v").flatten().to_numpy(), np.array(batch.column("v").offsets)
    offsets = offsets - offsets[0]
    for dim in np.unique(dims):
        own = np.flatnonzero(dims == dim)
        matrix = values[offsets[own][:, None] + np.arange(dim)]
        yield int(dim), (batch.column("vec_id").to_numpy()[own], batch.column("label").to_numpy()[own], matrix)


def narrow(matrix: np.ndarray) -> bytes:
    """Whole numbers in the narrowest signed width that holds them; the width comes first."""
    wide = np.abs(matrix).max(initial=0)
    kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if k == "<i8" or wide <= np.iinfo(k).max)
    return kind[-1].encode() + np.ascontiguousarray(matrix).astype(kind).tobytes()


def widened(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[:1].decode()}", offset=1).reshape(rows, -1)


class VerticalBlock:
    """A block in memory: ids, labels, one array per dimension, and the extremes of each."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.columns = widened(row["columns"], row["dim"]).astype(np.int64)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def scan(self, anchor: np.ndarray, candidates: np.ndarray, still_needed) -> tuple[np.ndarray, np.ndarray]:
        """Rows that matter to the end, and their exact scores.

        ``still_needed(least, most)`` gets the bounds of the rows in the bitmap and says which to keep.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        weights = anchor[order]
        ends = np.stack([weights * self.low[order], weights * self.high[order]])
        rest_low = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        rest_high = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        rows, partial = np.flatnonzero(candidates), np.zeros(int(candidates.sum()), np.int64)
        for at in range(0, len(order), STRIDE):
            read = order[at : at + STRIDE]
            # The first strides read whole columns; later ones only what the bitmap has left.
            part = self.columns[read] if len(rows) == len(self.ids) else self.columns[read[:, None], rows]
            partial = partial + weights[at : at + STRIDE] @ part
            done = min(at + STRIDE, len(order))
            keep = still_needed(partial + rest_low[done], partial + rest_high[done])
            if not keep.all():
                rows, partial = rows[keep], partial[keep]
            if not len(rows):
                break
        return rows, partial


def _kth(values: np.ndarray, k: int) -> int | None:
    """The k-th greatest of the values, if there are as many."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else None


def best_positives(block: VerticalBlock, anchor_id: int, label: int, anchor: np.ndarray, k: int):
    candidates = (block.labels == label) & (block.ids != anchor_id)

    def still_needed(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        threshold = _kth(least, k)
        return np.ones(len(least), bool) if threshold is None else most >= threshold

    rows, scores = block.scan(anchor, candidates, still_needed)
    first = np.lexsort((block.ids[rows], -scores))[:k]
    return rows[first], scores[first]


def first_negatives(block: VerticalBlock, anchor_id: int, label: int, anchor: np.ndarray, positives: np.ndarray, k: int):
    """Per positive score (a window) its first k negatives in the block: window numbers, rows, scores."""
    candidates = (block.labels != label) & (block.ids != anchor_id)
    lower, upper = positives * LEAST_PERCENT, positives * MOST_PERCENT

    def still_needed(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(least), bool)
        for low, high in zip(lower, upper):
            reach = (100 * most >= low) & (100 * least <= high)
            sure = least[(100 * least >= low) & (100 * most <= high)]
            tenth = _kth(sure, k)
            keep |= reach if tenth is None else reach & (most >= tenth)
        return keep

    rows, scores = block.scan(anchor, candidates, still_needed)
    windows, found, values = [], [], []
    for j, (low, high) in enumerate(zip(lower, upper)):
        inside = np.flatnonzero((100 * scores >= low) & (100 * scores <= high))
        first = inside[np.lexsort((block.ids[rows[inside]], -scores[inside]))[:k]]
        windows.append(np.full(len(first), j))
        found.append(rows[first])
        values.append(scores[first])
    return np.concatenate(windows), np.concatenate(found), np.concatenate(values)


def _packs(anchors: DataFrame) -> DataFrame:
    """Anchors with ``positives`` (scores, best first), ``PACK`` of one dimension count to a row."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            rows = batch.to_pylist()
            for dim in sorted({r["dim"] for r in rows}):
                own = [r for r in rows if r["dim"] == dim]
                for at in range(0, len(own), PACK):
                    some = own[at : at + PACK]
                    width = max(len(r["positives"]) for r in some)
                    # Rows of different lengths are filled up: the count comes first.
                    scores = [[len(r["positives"]), *r["positives"], *[0] * (width - len(r["positives"]))] for r in some]
                    columns = [
                        [number],
                        [dim],
                        [np.array([r["vec_id"] for r in some], np.int64).tobytes()],
                        [np.array([r["label"] for r in some], np.int64).tobytes()],
                        [narrow(np.array([r["v"] for r in some], np.int64))],
                        [np.array(scores, np.int64).tobytes()],
                    ]
                    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_names(_PACKS))
                    number += 1

    return staged(anchors.select("vec_id", "label", "v", "dim", "positives").mapInArrow(packed, _PACKS), "anchor-packs")


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _visits(blocks: DataFrame, packs: DataFrame, work, schema: str) -> DataFrame:
    """``work(block, anchor rows)`` for every block and every pack of its dimension count.

    Block numbers meet packs over (dimension count, number hash), so that no task joins them all; a block and the
    packs that visit it meet in one partition, the block first, and are read as a stream.
    """
    spread = F.sequence(F.lit(0), F.lit(_SPREAD - 1))
    numbers = blocks.select("block", "dim", F.pmod(F.xxhash64("block"), F.lit(_SPREAD)).cast("int").alias("_s"))
    there = packs.withColumn("_s", F.explode(spread)).join(numbers, ["dim", "_s"]).drop("_s")
    shared = ("block", "dim", "labels")
    none = F.lit(None).cast("binary")
    left = blocks.select(*shared, "ids", "columns", *[none.alias(c) for c in ("anchors", "vectors", "positives")])
    right = there.select(*shared, none.alias("ids"), none.alias("columns"), "anchors", "vectors", "positives")
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = left.unionByName(right).repartition(tasks, "block")
    ordered = met.withColumn("_kind", F.col("anchors").isNotNull()).sortWithinPartitions("block", "_kind").drop("_kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["anchors"] is None:
                    block = VerticalBlock(row)
                    continue
                found = work(block, row)
                if found is not None:
                    columns = [pa.array(c, pa.int64()) for c in found]
                    yield pa.RecordBatch.from_arrays(columns, names=_names(schema))

    return ordered.mapInArrow(run, schema)


def _anchor_rows(row: dict) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    ids, labels = np.frombuffer(row["anchors"], np.int64), np.frombuffer(row["labels"], np.int64)
    vectors = widened(row["vectors"], len(ids)).astype(np.int64)
    scores = np.frombuffer(row["positives"], np.int64).reshape(len(ids), -1)
    for i, anchor in enumerate(ids):
        yield int(anchor), int(labels[i]), vectors[i], scores[i, 1 : 1 + scores[i, 0]]


def _joined(parts: list[tuple]) -> list[np.ndarray] | None:
    return [np.concatenate(column) for column in zip(*parts)] if parts else None


def mined(
    embeddings: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``."""
    rows = integer_rows(embeddings, F.col("label") if label is None else label, scale)
    blocks = vertical_blocks(rows)
    chosen = rows.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v", "dim")).alias("_row"))
    anchors = staged(chosen.select("vec_id", "_row.*"), "anchors")

    def positive_rows(block: VerticalBlock, row: dict):
        parts = []
        for anchor_id, own, vector, _ in _anchor_rows(row):
            found, scores = best_positives(block, anchor_id, own, vector, positives)
            parts.append((np.full(len(found), anchor_id), block.ids[found], scores))
        return _joined(parts)

    alone = anchors.withColumn("positives", F.array().cast("array<bigint>"))
    met = _visits(blocks, _packs(alone), positive_rows, "anchor_id bigint, positive_id bigint, positive_score bigint")
    best = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    ranked = met.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    pairs = staged(ranked, "positives")

    # Scores of an anchor's positives, best first; at most ``positives`` of them.
    own = pairs.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("_p"))
    with_windows = anchors.join(own.withColumnRenamed("anchor_id", "vec_id"), "vec_id").withColumn(
        "positives", F.col("_p.positive_score")
    )

    def negative_rows(block: VerticalBlock, row: dict):
        parts = []
        for anchor_id, own_label, vector, scores in _anchor_rows(row):
            window, found, values = first_negatives(block, anchor_id, own_label, vector, scores, negatives)
            parts.append((np.full(len(found), anchor_id), window + 1, block.ids[found], values))
        return _joined(parts)

    found = _visits(
        blocks, _packs(with_windows), negative_rows, "anchor_id bigint, place bigint, negative_id bigint, negative_score bigint"
    )
    first = Window.partitionBy("anchor_id", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    kept = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= negatives)
    return kept.join(pairs.withColumn("place", F.col("place").cast("bigint")), ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
