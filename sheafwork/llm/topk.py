"""Exact top-k search by inner product: norm-bucketed retrieval.

Vectors are put in order of length (one range exchange, which also cuts a length that very many share)
and cut into buckets of ``BUCKET`` vectors. Every query first meets the bucket of the longest vectors; the
k-th score there is its threshold. Bucket by bucket, the threshold over both lengths is the cosine a
vector must reach. Over 1, the whole bucket is left out, before any vector moves. Else a bucket is
searched by coordinates where that cosine is high (each of the query's ``FOCUS`` largest
coordinates confines the same coordinate of a vector to an interval), or by length where it is low
(shorter vectors than threshold over query length are left out). What remains is verified by exact
integer products, and the best k of all buckets are merged.

Queries travel in blocks, and each pair of query block and bucket is a task's work of bounded size.
Scores must fit into 64 bits.

Defined results: vectors that are null, empty, or hold a null or non-finite component take no part, nor
do rows without an id; vectors of different dimensions never meet; a query's own row is no candidate
(repeated rows share an id, so none of them is); ties go to the smaller id; with fewer candidates than
k, all are returned; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged

SCALE, K = 256, 5
BUCKET, QUERIES = 4096, 512
FOCUS = 3
# From this cosine on, intervals of coordinates leave out more than lengths do.
STEEP = 0.3
_SLACK = 1e-9
_SPREAD = 16
_BLOCK = "block bigint, dim int, longest double, ids binary, data binary"
_FOUND = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``v`` (floor of scale times each component), ``dim`` and ``length`` of usable vectors."""
    wide = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.forall("_w", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).select("vec_id", wide.alias("_w"))
    whole = rows.filter(F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.transform("_w", lambda x: F.floor(x * scale).cast("bigint")).alias("v")
    )
    square = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return whole.select(F.col("vec_id").cast("bigint").alias("vec_id"), "v", F.size("v").alias("dim"), F.sqrt(square).alias("length"))


def blocks(vectors: DataFrame, most: int) -> DataFrame:
    """Vectors in order of length, ``most`` to a row: ``block``, ``dim``, ``longest``, ``ids``, ``data``."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def rows(all_of_it: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number
            while held and (all_of_it or len(held) >= most or held[0][1] != held[-1][1]):
                n = next((i for i, h in enumerate(held[:most]) if h[1] != held[0][1]), min(most, len(held)))
                own = held[:n]
                del held[:n]
                ids = np.array([h[0] for h in own], np.int64)
                data = np.stack([h[2] for h in own])
                columns = [[number], [own[0][1]], [max(h[3] for h in own)], [ids.tobytes()], [data.tobytes()]]
                types = (pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "dim", "longest", "ids", "data"])
                number += 1

        for batch in batches:
            values, offsets = batch.column("v").flatten().to_numpy(), np.array(batch.column("v").offsets)
            offsets = offsets - offsets[0]
            meta = zip(*[batch.column(c).to_pylist() for c in ("vec_id", "dim", "length")])
            for i, (vec_id, dim, length) in enumerate(meta):
                held.append((vec_id, dim, values[offsets[i] : offsets[i + 1]], length))
                if len(held) > most:
                    yield from rows(False)
        yield from rows(True)

    order = [F.col("dim"), F.col("length").desc(), F.col("vec_id")]
    ranged = vectors.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(ranged.mapInArrow(packed, _BLOCK), "vector-blocks")


def best_of_bucket(
    query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to k best vectors of a bucket per query, among those that reach the query's threshold."""
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    ids, vectors, lengths = ids[order], vectors[order], lengths[order]
    unit = (vectors / np.maximum(lengths, 1e-300)[:, None]).T
    exact = vectors.astype(np.float64)
    top = float(np.abs(exact).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, vectors.shape[1])
    in_doubles = top < 2.0**53
    found: tuple[list, list, list] = ([], [], [])
    for q_id, q, threshold in zip(query_ids, queries, least):
        length = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
        rows = np.arange(len(ids))
        if np.isfinite(threshold) and threshold > 0:
            reach = length * lengths[0]
            cosine = threshold / reach if reach > 0 else np.inf
            if cosine > 1 + _SLACK:
                continue
            cosine = min(cosine, 1.0)
            if cosine >= STEEP:
                u = q / length
                keep = np.ones(len(ids), bool)
                for f in np.argsort(-np.abs(u))[:FOCUS]:
                    half = np.sqrt(max(0.0, (1 - cosine**2) * (1 - u[f] ** 2)))
                    # A vector at an angle of at most arccos(cosine) to the query lies inside, unless the
                    # interval's end passes the pole, where the coordinate is free.
                    if u[f] < cosine:
                        keep &= unit[f] <= u[f] * cosine + half + 1e-7
                    if -u[f] < cosine:
                        keep &= unit[f] >= u[f] * cosine - half - 1e-7
                rows = np.flatnonzero(keep)
            else:
                rows = rows[: int(np.searchsorted(-lengths, -(threshold / length) * (1 - _SLACK), side="right"))]
        rows = rows[ids[rows] != q_id]
        if not len(rows):
            continue
        scores = (exact[rows] @ q.astype(np.float64)).astype(np.int64) if in_doubles else vectors[rows] @ q
        reached = scores >= threshold
        rows, scores = rows[reached], scores[reached]
        first = np.lexsort((ids[rows], -scores))[:k]
        found[0].append(np.full(len(first), q_id))
        found[1].append(ids[rows[first]])
        found[2].append(scores[first])
    return tuple(np.concatenate(f) if f else np.empty(0, np.int64) for f in found)


def search(embeddings: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's k best vectors."""
    vectors = integer_vectors(embeddings, scale)
    buckets = blocks(vectors, BUCKET)
    asked = blocks(vectors.filter(is_query), QUERIES)

    def compare(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        q = next(r for r in rows if r["threshold"] is not None)
        b = next(r for r in rows if r["threshold"] is None)
        matrix = lambda r: np.frombuffer(r["data"], np.int64).reshape(-1, r["dim"])
        numbers = lambda r: np.frombuffer(r["ids"], np.int64)
        least = np.frombuffer(q["threshold"], np.float64)
        least = least if len(least) else np.full(len(numbers(q)), -np.inf)
        found = best_of_bucket(numbers(q), matrix(q), least, numbers(b), matrix(b), k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found)))

    def compared(pairs: DataFrame, queries: DataFrame) -> DataFrame:
        left = pairs.join(queries, "query_block").select("query_block", "block", "dim", "ids", "data", "threshold")
        right = pairs.join(buckets.drop("longest"), "block").select(
            "query_block", "block", "dim", "ids", "data", F.lit(None).cast("binary").alias("threshold")
        )
        return left.unionByName(right).groupBy("query_block", "block").applyInArrow(compare, _FOUND)

    named = asked.withColumnRenamed("block", "query_block")
    # One row per dimension: the bucket of the longest vectors.
    longest = buckets.groupBy("dim").agg(F.min("block").alias("block"))
    seeds = named.select("query_block", "dim").join(longest, "dim").select("query_block", "block")
    seeded = staged(compared(seeds, named.withColumn("threshold", F.lit(b""))), "seed-scores")

    kth = seeded.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
    thresholds = staged(kth.select("query_id", F.when(F.col("n") >= k, F.col("low").cast("double")).alias("least")), "thresholds")
    ready = staged(_with_thresholds(named, thresholds), "query-blocks")

    # Numbers of blocks only: which buckets can hold a vector for which query block.
    spread = F.sequence(F.lit(0), F.lit(_SPREAD - 1))
    questions = ready.select("query_block", "dim", F.col("longest").alias("_q"), "lowest", F.explode(spread).alias("_s"))
    shelves = buckets.join(longest.withColumnRenamed("block", "_seed"), "dim").filter("block <> _seed")
    shelves = shelves.select("block", "dim", F.col("longest").alias("_b"), F.pmod(F.xxhash64("block"), F.lit(_SPREAD)).cast("int").alias("_s"))
    pairs = questions.join(shelves, ["dim", "_s"]).filter(F.col("_q") * F.col("_b") * (1 + _SLACK) >= F.col("lowest"))
    rest = compared(pairs.select("query_block", "block"), ready.select("query_block", "dim", "ids", "data", "threshold"))

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    merged = seeded.unionByName(rest).withColumn("rank", F.row_number().over(best))
    return merged.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _with_thresholds(named: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Query blocks with the array of their queries' thresholds (none yet: minus infinity)."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids in zip(batch.column("query_block").to_pylist(), batch.column("ids").to_pylist()):
                own = np.frombuffer(ids, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), block)), pa.array(np.arange(len(own))), pa.array(own)],
                    names=["query_block", "place", "query_id"],
                )

    def packed(table: pa.Table) -> pa.Table:
        least = np.array([-np.inf if x is None else x for x in table.column("least").to_pylist()])
        least = least[np.argsort(table.column("place").to_numpy())]
        return pa.table(
            {"query_block": table.column("query_block")[:1], "threshold": [least.astype(np.float64).tobytes()], "lowest": [float(least.min())]}
        )

    places = named.select("query_block", "ids").mapInArrow(unpacked, "query_block bigint, place bigint, query_id bigint")
    lists = places.join(thresholds, "query_id", "left").groupBy("query_block")
    return named.join(lists.applyInArrow(packed, "query_block bigint, threshold binary, lowest double"), "query_block")
