"""Quality of a lossy copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Mark of a recompressed copy and the greatest value of a band.
COPY_MARK = "recompressed_"
PEAK = 255


def paired(originals: DataFrame, copies: DataFrame) -> DataFrame:
    """``name, px, copy_px``: each image with the copy that bears its name."""
    return originals.select("name", "px").join(_marked(copies), "name")


def all_paired(originals: DataFrame, copies: DataFrame) -> DataFrame:
    """As ``paired``, with a row for either side alone and ``error``: what keeps a pair from being measured.

    A side that could not be decoded comes with null ``px``.
    """
    left = originals.select("name", "px", F.lit(True).alias("_original"))
    both = left.join(_marked(copies).withColumn("_copy", F.lit(True)), "name", "full")
    faults = [
        F.when(F.col("_original").isNull(), "no original").when(F.col("px").isNull(), "unreadable original"),
        F.when(F.col("_copy").isNull(), "no copy").when(F.col("copy_px").isNull(), "unreadable copy"),
    ]
    said = F.concat_ws(", ", *faults)
    sizes = F.when(F.size("px") != F.size("copy_px"), F.lit("different sizes"))
    return both.select("name", "px", "copy_px", F.when(said != "", said).otherwise(sizes).alias("error"))


def _marked(copies: DataFrame) -> DataFrame:
    name = F.regexp_replace("name", "^" + COPY_MARK, "")
    marked = copies.filter(F.col("name").startswith(COPY_MARK))
    return marked.select(name.alias("name"), F.col("px").alias("copy_px"))


def mean_square_error(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y).cast("bigint") * (x - y))
    total = F.aggregate(squares, F.lit(0).cast("bigint"), lambda s, x: s + x)
    return F.try_divide(total.cast("double"), F.size(a).cast("double"))


def with_psnr(pairs: DataFrame) -> DataFrame:
    """Adds ``mse, psnr, identical``; equal images have no finite ratio, so theirs is null."""
    mse = F.col("mse")
    ratio = F.when(mse > 0, F.lit(10.0) * F.log10(F.lit(float(PEAK * PEAK)) / mse))
    return pairs.withColumn("mse", mean_square_error(F.col("px"), F.col("copy_px"))).select(
        "*", ratio.alias("psnr"), (mse == 0).alias("identical")
    )
