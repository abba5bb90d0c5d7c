"""CSV and JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import written_rank

# Fixed value: the row-index column of a CSV has no name.
INDEX_NAME = ""


def with_row_index(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``row_index``: 0-based position in ``order``. Rows keep it through a later split.

    The rows are written once; reading the result again does not order them again.
    """
    return written_rank(df, order, "_rank").withColumn("row_index", F.col("_rank") - 1).drop("_rank")


def write_csv(df: DataFrame, path: str, index: str | None = None, mode: str = "errorifexists") -> None:
    """CSV with header; ``index`` names the column written first and without a name."""
    if index:
        df = df.select(F.col(index).alias(INDEX_NAME), *[c for c in df.columns if c != index])
    df.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line; null fields are written."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
