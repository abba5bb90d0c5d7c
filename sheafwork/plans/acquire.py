"""Acquisition: what to do per id, which links to try, and what came of the attempts.

The links themselves are fetched elsewhere; that step reads ``links_to_try`` and delivers the
attempt log (``schemas.ATTEMPTS``) and the decode results this job settles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.store import store_path
from ..operators.attempts import (
    broken_hosts,
    final_states,
    first_success,
    host_errors,
    run_milestones,
    state_totals,
    top_hosts,
)
from ..operators.candidates import expanded, ordered_candidates
from ..operators.catalogue import only_country
from ..operators.evidence import id_evidence
from ..operators.install import duplicate_removals, planned
from ..sinks.checkpoint import append_ids
from ..sources.idlist import read_lines
from ..sources.listing import list_files, resolved
from ..sources.tsv import read_catalogue, read_catalogue_strict
from ..staging import staged

DONE_LIST, FAILED_LIST = "processed_ids.txt", "failed_ids.txt"


@dataclass(frozen=True)
class Inputs:
    catalogue: DataFrame
    done: DataFrame
    failed: DataFrame
    prior: list[DataFrame]
    inventory: DataFrame
    store: str


def read_inputs(
    spark: SparkSession,
    catalogue_path: str,
    status_dir: str,
    store: str,
    prior_paths: list[str] | None = None,
    country: str | None = None,
) -> Inputs:
    # The listing gives this form of the path, and evidence compares it.
    place = resolved(store)
    return Inputs(
        catalogue=only_country(read_catalogue(spark, catalogue_path), country),
        done=read_lines(spark, f"{status_dir}/{DONE_LIST}"),
        failed=read_lines(spark, f"{status_dir}/{FAILED_LIST}"),
        prior=[read_catalogue_strict(spark, p, ["gbifID"]) for p in prior_paths or []],
        inventory=list_files(spark, place),
        store=place,
    )


def plan(inputs: Inputs) -> DataFrame:
    """``action`` per catalogue id; written once, because links, removals and records follow from it."""
    evidence = id_evidence(
        inputs.catalogue, inputs.done, inputs.failed, inputs.prior, inputs.inventory, inputs.store
    )
    return staged(planned(evidence), "plan")


def links_to_try(plan_rows: DataFrame, inputs: Inputs, manifests: DataFrame) -> DataFrame:
    """``gbif_id, pos, candidate_url`` for the ids that need an image."""
    wanted = plan_rows.filter(F.col("action").isin("fetch", "refetch")).select(F.col("id").cast("bigint").alias("gbif_id"))
    links = inputs.catalogue.join(wanted, "gbif_id", "left_semi")
    return ordered_candidates(staged(expanded(links, manifests), "candidates"))


def removals(plan_rows: DataFrame, inputs: Inputs) -> DataFrame:
    return duplicate_removals(plan_rows, inputs.store)


def record_present(plan_rows: DataFrame, status_dir: str) -> None:
    """Ids whose stored file is good go onto the done list."""
    append_ids(plan_rows.filter(F.col("action") == "record_done"), f"{status_dir}/{DONE_LIST}")


def settle(attempts: DataFrame, unreadable: DataFrame, status_dir: str) -> DataFrame:
    """Append done and failed ids to their lists; gives the totals.

    ``unreadable`` holds the ``attempt_id`` of images that could not be decoded.
    """
    bad = unreadable.select("attempt_id").distinct().withColumn("bad", F.lit(True))
    hits = final_states(attempts, F.lit(True)).join(bad, "attempt_id", "left")
    state = F.when(F.col("bad"), "failed").otherwise(F.col("state"))
    states = staged(hits.select(F.col("gbif_id").alias("id"), state.alias("state")), "states")
    for name, path in (("done", DONE_LIST), ("failed", FAILED_LIST)):
        append_ids(states.filter(F.col("state") == name), f"{status_dir}/{path}")
    return state_totals(states)


def undecodable(attempts: DataFrame, unreadable: DataFrame, store: str) -> DataFrame:
    """``gbif_id, path`` of stored files to remove because their image could not be decoded."""
    hits = final_states(attempts, F.lit(True)).join(unreadable.select("attempt_id").distinct(), "attempt_id", "left_semi")
    return hits.select("gbif_id", store_path(resolved(store), F.col("gbif_id").cast("string")).alias("path"))


def milestones(attempts: DataFrame, plan_rows: DataFrame, stored: int = 0, **intervals) -> DataFrame:
    """Milestones of a run, with what remained of its plan then; ``stored`` files were there before."""
    planned = plan_rows.filter(F.col("action").isin("fetch", "refetch")).count()
    return run_milestones(first_success(attempts), planned, stored, **intervals)


def host_summary(attempts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Number of broken hosts, and the hosts with most errors."""
    errors = host_errors(attempts)
    return broken_hosts(errors), top_hosts(errors)
