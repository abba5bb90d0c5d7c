"""Link check: which answers of an attempt log are no image."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.attempts import invalid_links, link_summary


def check(attempts: DataFrame, any_image_type: bool = False) -> tuple[DataFrame, DataFrame]:
    """Invalid links and their counts.

    By default only ``image/jpeg`` is valid; ``any_image_type`` accepts every ``image/`` type.
    """
    wrong = invalid_links(attempts)
    if any_image_type:
        image = F.coalesce(F.lower("content_type").startswith("image/"), F.lit(False))
        wrong = attempts.filter((F.col("status") == 200) & ~image)
    return wrong.select("gbif_id", "url", "content_type"), link_summary(attempts)

