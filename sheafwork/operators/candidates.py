"""Candidate links: manifests read and expanded, candidates put in a repeatable random order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import is_manifest_link
from ..schemas import MANIFEST
from .ordered import rank_in_key
from .skew import heavy_keys, spread_join

# Image widths asked of an image service, widest first, and the link they go into.
WIDTHS = (1600, 1200, 800)
SIZED_LINK = "/full/%d,/0/default.jpg"


def manifest_image_urls(body: Column) -> Column:
    """Links named by a manifest, in order; an empty list when it names none or cannot be read."""
    canvases = F.filter(F.from_json(body, MANIFEST).getField("items"), lambda c: c["type"] == "Canvas")
    pages = F.filter(_flat(canvases, lambda c: c["items"]), lambda p: p["type"] == "AnnotationPage")
    services = _flat(_flat(pages, lambda p: p["items"]), lambda a: a["body"]["service"])
    ids = F.filter(F.transform(services, lambda s: s["id"]), lambda i: i.isNotNull())
    sized = _flat(ids, lambda i: F.array(*[F.concat(i, F.lit(SIZED_LINK % w)) for w in WIDTHS]))
    return F.coalesce(sized, F.array().cast("array<string>"))


def _flat(array: Column, part) -> Column:
    """Concatenate one array per element, skipping elements without it."""
    return F.flatten(F.filter(F.transform(array, part), lambda x: x.isNotNull()))


def manifest_urls(manifests: DataFrame) -> DataFrame:
    """``url, pos, image_url`` for manifests given as ``url, body``."""
    return manifests.select("url", F.posexplode(manifest_image_urls(F.col("body"))).alias("pos", "image_url"))


def expanded(catalogue: DataFrame, manifests: DataFrame) -> DataFrame:
    """``gbif_id, candidate_url``: manifest links replaced by the images they name.

    A manifest that names none stays a candidate itself. Only manifest links take part in the join;
    all other rows pass through without an exchange. Missing links are dropped; ``manifests`` has one row per ``url``.
    """
    links = catalogue.filter(F.col("gbif_id").isNotNull() & F.col("identifier").isNotNull()).select(
        "gbif_id", "identifier"
    )
    plain = links.filter(~is_manifest_link(F.col("identifier")))
    read = manifests.select(F.col("url").alias("identifier"), manifest_image_urls(F.col("body")).alias("urls"))
    linked = links.filter(is_manifest_link(F.col("identifier")))
    heavy = heavy_keys(linked, "identifier")["identifier"]
    # A link is placed by its id, which a task that runs again reads again.
    named = (
        spread_join(linked, read, heavy, by=F.col("gbif_id"), how="left")
        .withColumn("urls", F.when(F.size("urls") > 0, F.col("urls")).otherwise(F.array("identifier")))
        .select("gbif_id", F.explode("urls").alias("candidate_url"))
    )
    return plain.withColumnRenamed("identifier", "candidate_url").unionByName(named)


def ordered_candidates(candidates: DataFrame, seed: str = "42") -> DataFrame:
    """``gbif_id, pos, candidate_url`` in an order that looks random but repeats.

    ``candidates`` is read twice; give it as a written table.
    """
    mix = F.md5(F.concat_ws("|", F.col("gbif_id").cast("string"), "candidate_url", F.lit(seed)))
    # Copies of a link are told apart by where they are read, so that a pile of copies can be cut too.
    shuffled = candidates.withColumns({"_mix": mix, "_copy": F.monotonically_increasing_id()})
    heavy = heavy_keys(candidates, "gbif_id")["gbif_id"]
    order = ["_mix", "candidate_url", "_copy"]
    return rank_in_key(shuffled, "gbif_id", order, "pos", heavy, drop=["_mix", "_copy"]).select(
        "gbif_id", "pos", "candidate_url"
    )
