"""Append-only id lists in which each id appears once.

A list is text, one id a line: a folder that appends add files to, or a plain file, which is never rewritten. Beside it
lies a table in hash buckets (``buckets``) with the list's ids, so an append reads only the buckets it has ids for. The
table knows the files it was made from; when the text has grown in another way, it takes the text in once more. That is
also what mends an append that died between text and table. Lists fed batch by batch, as by a stream, are such a table
and nothing else, unless there is text at their path.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evidence import clean_ids
from ..sources.idlist import beside, is_table, plain_lines
from ..staging import staged
from .buckets import BucketTable


def table_of(spark: SparkSession, path: str) -> BucketTable:
    """The table that holds the ids of the list at ``path``, or will."""
    plain = not is_table(spark, path) and plain_lines(spark, path) is not None
    return BucketTable(spark, beside(path) if plain else path)


def signature(spark: SparkSession, path: str) -> tuple[str, bool]:
    """Number, bytes and latest change of a list's files, and whether it is one plain file; contents are not read."""
    try:
        files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return "", False
    told = [F.count("*").alias("n"), F.sum("length").alias("size"), F.max("modificationTime").alias("at"), F.min("path").alias("first")]
    row = files.agg(*told).first()
    name = path.rstrip("/").rsplit("/", 1)[-1]
    alone = row["n"] == 1 and row["first"].endswith(f"/{name}") and not row["first"].endswith(f"/{name}/{name}")
    return f"{row['n']} {row['size']} {row['at']}", alone


def append_ids(ids: DataFrame, path: str, batch: int | None = None) -> None:
    """Append the unseen ids, each once. A batch number that was applied already changes nothing.

    A job that fails leaves the list without its ids or with all of them.
    """
    spark = ids.sparkSession
    keyed = ids.select(F.col("id").cast("string").alias("key")).filter("key IS NOT NULL")
    if is_table(spark, path) or (batch is not None and plain_lines(spark, path) is None):
        BucketTable(spark, path).add_new(keyed, batch)
        return
    table = BucketTable(spark, beside(path))
    current, alone = signature(spark, path)
    if table.version().origin != current:
        table.add_new(clean_ids(plain_lines(spark, path)).select(F.col("id").alias("key")), origin=current)
    if batch is not None or alone:
        table.add_new(keyed, batch)
        return
    fresh = staged(table.unseen(keyed), "unseen-ids")
    if not fresh.isEmpty():
        fresh.write.mode("append").text(path)
        table.add_new(fresh, origin=signature(spark, path)[0])
