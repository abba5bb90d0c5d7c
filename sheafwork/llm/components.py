"""Connected components of a graph given as rows ``(a, b)`` of node numbers.

Small-star and large-star steps in turn: a node's neighbours are tied to the least of them, until
nothing changes. Each step adds up (a minimum per node) before it exchanges, and no task ever holds the
neighbours of one node. Every round is written to the shared folder, so a lost executor costs a round's
part at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import staged


# Edges in one task. Graphs of near copies are small next to the texts they come from, and a round over
# them should not cost a task for every partition of the texts.
EDGES = 200_000


def _written(df: DataFrame, tasks: int, label: str) -> DataFrame:
    return staged(df.coalesce(tasks), label)


def _least(edges: DataFrame, tasks: int) -> DataFrame:
    """Per node the least of itself and its neighbours; read back from files, so that a join with a hot
    node can be split."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return _written(least, tasks, "least")


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Ties every greater neighbour of a node to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    tied = both.join(_least(both, tasks), "a").filter("b > a")
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Ties a node's lesser neighbours, and the node, to the least of them."""
    least = _least(edges, tasks)
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (least node reachable) for every node of an edge with another end."""
    a, b = F.col("a").cast("bigint"), F.col("b").cast("bigint")
    links = staged(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), "links")
    before, tasks = None, 1 + links.count() // EDGES
    while True:
        large = _written(_large_star(links, tasks).filter("a <> b").distinct(), tasks, "links")
        stars = _written(_small_star(large, tasks).filter("a <> b").distinct(), tasks, "links")
        state = stars.agg(F.count("*").alias("n"), F.sum(F.col("b").cast("decimal(38,0)")).alias("s")).first()
        if before == (state["n"], state["s"]):
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        links, before = stars, (state["n"], state["s"])
        tasks = 1 + state["n"] // EDGES
