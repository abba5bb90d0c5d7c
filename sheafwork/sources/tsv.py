"""Tab-separated catalogues with a header.

The header decides the position of each column, then an explicit schema is read, so nothing is
inferred and only the wanted columns are parsed. Rows with too few fields are filled with nulls and
extra fields are dropped; no row is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CATALOGUE_FILE


class MissingColumns(ValueError):
    """The file lacks columns the caller cannot do without."""


def _options(reader):
    return reader.option("sep", "\t").option("header", True).option("escape", '"').option("mode", "PERMISSIVE")


def header_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names; reads one line."""
    return _options(spark.read).csv(path).columns


def read_catalogue(
    spark: SparkSession,
    path: str | list[str],
    wanted: Sequence[str] = tuple(CATALOGUE_FILE),
    required: Sequence[str] = (),
) -> DataFrame:
    """Catalogue columns under our names; a wanted column the file lacks is null throughout.

    ``required`` columns must be there. An id that is no number is read as null. All files of one read
    must have the same header; one with other columns, or in another order, stops the read. A quoted
    line break ends a row.
    """
    header = header_of(spark, path)
    missing = [c for c in required if c not in header]
    if missing:
        raise MissingColumns(f"columns not in {path}: {', '.join(missing)}")
    schema = T.StructType(
        [
            T.StructField(name, CATALOGUE_FILE[name][1] if name in wanted else T.StringType())
            for name in header
        ]
    )
    rows = _options(spark.read).option("enforceSchema", False).schema(schema).csv(path)
    columns = []
    for name in wanted:
        ours, kind = CATALOGUE_FILE[name]
        columns.append((F.col(f"`{name}`") if name in header else F.lit(None).cast(kind)).alias(ours))
    return rows.select(*columns)


def read_catalogue_strict(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] = ("gbifID", "identifier")
) -> DataFrame:
    """All of ``columns`` must be in the file."""
    return read_catalogue(spark, path, columns, required=columns)
