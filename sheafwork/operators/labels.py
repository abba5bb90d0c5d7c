"""Metadata bundles joined into labelled rows.

The joins carry no broadcast hint: Spark broadcasts a dimension when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise. Keys that own a large share of
the annotations are spread over tasks in either case (``skew``): they are looked for in one narrow scan, so no estimate
of a size can leave them in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import caption, scientific_name, word
from .ordered import exact_rank
from .skew import heavy_keys, spread_join


def last_wins(df: DataFrame, key: str, position: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one at the last position.

    Without a position column the greatest row is taken, which makes repeated rows harmless.
    """
    values = [c for c in df.columns if c != key and c not in (position or [])]
    kept = F.struct(*values)
    chosen = F.max_by(kept, F.struct(*position)) if position else F.max(kept)
    return df.groupBy(key).agg(chosen.alias("_row")).select(key, "_row.*")


def _star_join(annotations: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Annotations with one row of each dimension; every dimension is deduplicated first."""
    keyed = {key: last_wins(dimension, key) for key, dimension in dimensions.items()}
    heavy = heavy_keys(annotations, *keyed)
    rows = annotations
    for key, dimension in keyed.items():
        rows = spread_join(rows, dimension, heavy[key], by=F.col("id"))
    return rows


def label_join_2022(
    annotations: DataFrame, images: DataFrame, categories: DataFrame, institutions: DataFrame
) -> DataFrame:
    """Images are looked up by ``image_id``; names come from the category's own columns."""
    names = categories.select("category_id", "family", "genus", "species")
    star = {"image_id": images, "category_id": names, "institution_id": institutions}
    return _star_join(annotations, star).select(
        "id",
        "image_id",
        F.col("file_name").alias("filename"),
        "species",
        "genus",
        "family",
        F.col("collection_code").alias("institution"),
    )


def label_join_2021(
    annotations: DataFrame, images: DataFrame, categories: DataFrame, institutions: DataFrame
) -> DataFrame:
    """Images are looked up by the annotation's own id; genus and species are words of the name."""
    names = categories.select("category_id", "name", "family")
    facts = annotations.select("id", "category_id", "institution_id")
    star = {"id": images, "category_id": names, "institution_id": institutions}
    return _star_join(facts, star).select(
        "id",
        F.col("id").alias("image_id"),
        F.replace("file_name", F.lit("images/"), F.lit("")).alias("filename"),
        word(F.col("name"), 1).alias("species"),
        word(F.col("name"), 0).alias("genus"),
        "family",
        F.col("institution_name").alias("institution"),
    )


def key_violations(annotations: DataFrame, dimensions: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Annotation rows without a partner, per dimension.

    ``dimensions`` maps a name to the key column (of both sides) and the dimension. All keys are
    read in one scan and counted before they meet the dimensions, so a much-used key is one row. Keys
    are compared as text, as some bundles name images by text.
    """
    pairs = ", ".join(f"'{name}', cast({key} as string)" for name, (key, _) in dimensions.items())
    used = (
        annotations.selectExpr(f"stack({len(dimensions)}, {pairs}) as (dimension, key)")
        .groupBy("dimension", "key")
        .agg(F.count("*").alias("n"))
    )
    known = None
    for name, (key, df) in dimensions.items():
        part = df.select(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key")).distinct()
        known = part if known is None else known.unionAll(part)
    found = used.join(known.withColumn("known", F.lit(True)), ["dimension", "key"], "left")
    missing = F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0))
    return found.groupBy("dimension").agg(missing.cast("bigint").alias("n_missing"))


def with_names(joined: DataFrame) -> DataFrame:
    """Adds the caption and the scientific name."""
    return joined.withColumn("caption", caption(*[F.col(c) for c in ("species", "genus", "family", "institution")])).withColumn(
        "scientific_name", scientific_name(F.col("family"), F.col("genus"), F.col("species"))
    )


def label_codes(named: DataFrame) -> DataFrame:
    """``scientific_name, code``: codes 0 .. n-1 in code-point order of the names."""
    names = named.select("scientific_name").filter(F.col("scientific_name").isNotNull()).distinct()
    return exact_rank(names, ["scientific_name"], "_rank").select(
        "scientific_name", (F.col("_rank") - 1).alias("code")
    )
