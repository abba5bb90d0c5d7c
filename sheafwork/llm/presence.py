"""Rows told apart by whether their key can be among a list of keys, so that only those few meet the list.

Joining documents with a list that names few of them would exchange every text. A blocked Bloom filter of the list (see
``url_filter``, 4 MB at most, however long the list is) is broadcast instead: rows that miss a bit are surely not on
the list and stay where they are. The others are for the caller's exact join, which removes the false positives; a
fuller filter lets more of them pass, never fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .url_filter import blocks_for, possible


def told_apart(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key`` may be in ``keys`` (one column, of the same type, written once), and all others.

    Null keys are among the others.
    """
    listed = keys.toDF("canonical")
    # Columns travel inside a struct, so that none can clash with the names used here.
    packed = rows.select(F.struct(*rows.columns).alias("_row"), key.alias("_key"))
    probed = possible(packed, listed, blocks_for(listed.count()))
    return probed.filter("_possible").select("_row.*"), probed.filter("NOT _possible").select("_row.*")
