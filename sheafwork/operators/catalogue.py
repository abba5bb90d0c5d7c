"""The media catalogue: candidates per id, country filter, hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import host_of


def candidate_lists(catalogue: DataFrame, order: str = "row_id") -> DataFrame:
    """``gbif_id, n_urls, urls``: the links of each id in file order, missing links included.

    The list of an id is one value, so it suits ids whose links fit into a row. Jobs work on the
    long form (``candidates.expanded``); this is for callers who want the list itself.
    """
    entries = F.array_sort(F.collect_list(F.struct(order, "identifier")))
    return (
        catalogue.filter(F.col("gbif_id").isNotNull())
        .groupBy("gbif_id")
        .agg(F.count("*").alias("n_urls"), entries.alias("entries"))
        .select("gbif_id", "n_urls", F.col("entries.identifier").alias("urls"))
    )


def only_country(catalogue: DataFrame, country: str | None) -> DataFrame:
    """Rows of one country; everything when no country is given or the file has no such column."""
    if not country or "country_code" not in catalogue.columns:
        return catalogue
    return catalogue.filter(F.col("country_code") == country)


def hosts(catalogue: DataFrame) -> DataFrame:
    """Links per host."""
    links = catalogue.filter(F.col("identifier").isNotNull())
    return links.groupBy(host_of(F.col("identifier")).alias("host")).agg(F.count("*").alias("n_urls"))


def distinct_ids(catalogue: DataFrame) -> DataFrame:
    return catalogue.filter(F.col("gbif_id").isNotNull()).select("gbif_id").distinct()
