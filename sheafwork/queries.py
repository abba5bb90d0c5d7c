"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.store import STORE_BOX, fit_edge
from .operators import attempts as log
from .operators import candidates, catalogue, guard, install, labels, layout, progress, quality, split
from .operators.evidence import clean_ids, id_evidence, remaining
from .staging import pinned, staged
from .standins import view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TIME, STATUS_DIR, OUTPUT_DIR = "2024-01-01 00:00:00", "/status", "/out"
COUNTRY = "NATION_7"
MILESTONE_EVERY = 100


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [view(spark, sf_dir, n) for n in names]


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_evidence(*_views(spark, sf_dir, "multimedia", "processed_ids", "failed_ids"))


def _full_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = partial(view, spark, sf_dir)
    return id_evidence(
        v("multimedia"), v("processed_ids"), v("failed_ids"), [v("prior_a"), v("prior_b")], v("store_files")
    )


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.state_counts(_evidence(spark, sf_dir))


def _catalogue_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.state_counts(id_evidence(view(spark, sf_dir, "multimedia")))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def _numeric_id(df: DataFrame) -> DataFrame:
    return df.withColumn("gbif_id", F.col("id").cast("bigint"))


# Progress


@query
def q_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(progress.progress(_states(spark, sf_dir)), "pct_processed", "pct_failed", "pct_remaining")


@query
def q_id_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_ids(view(spark, sf_dir, "processed_ids"))


@query
def q_catalogue_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(progress.catalogue_stats(_catalogue_states(spark, sf_dir)), "avg_urls")


@query
def q_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.distribution(_catalogue_states(spark, sf_dir)).orderBy("num_images")


@query
def q_urls_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.urls_by_state(_states(spark, sf_dir))


@query
def q_extra_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.extra_ids(_evidence(spark, sf_dir))


@query
def q_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.report_lines(pinned(_states(spark, sf_dir)), RUN_TIME, STATUS_DIR, OUTPUT_DIR)


# Catalogue and plan


@query
def q_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = catalogue.candidate_lists(view(spark, sf_dir, "multimedia"))
    return lists.withColumn("urls", F.array_join("urls", "|", ""))


@query
def q_country_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.only_country(view(spark, sf_dir, "multimedia"), COUNTRY).select("row_id", "gbif_id")


@query
def q_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.hosts(view(spark, sf_dir, "multimedia"))


@query
def q_store_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.store_places(catalogue.distinct_ids(view(spark, sf_dir, "multimedia")))


@query
def q_prior_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return install.prior_ids(*_views(spark, sf_dir, "prior_a", "prior_b"))


@query
def q_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = partial(view, spark, sf_dir)
    known = id_evidence(v("multimedia"), prior=[v("prior_a"), v("prior_b")])
    return _numeric_id(install.duplicates(known)).select("gbif_id")


@query
def q_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numeric_id(remaining(_evidence(spark, sf_dir))).select("gbif_id")


@query
def q_install_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numeric_id(install.planned(_full_evidence(spark, sf_dir))).select("gbif_id", "action")


@query
def q_duplicate_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = install.planned(_full_evidence(spark, sf_dir))
    return _numeric_id(install.duplicate_removals(plan)).select("gbif_id", "path")


@query
def q_store_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, stored = _views(spark, sf_dir, "files", "store_files")
    flat = layout.count_files(files, "flat", recursive=False)
    return _rounded(flat.unionAll(layout.count_files(stored, "store")), "mb")


@query
def q_files_by_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.by_extension(view(spark, sf_dir, "files"))


@query
def q_reorg_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.reorganise_plan(view(spark, sf_dir, "files"))


@query
def q_reorg_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.action_counts(layout.reorganise_plan(view(spark, sf_dir, "files")))


@query
def q_resize_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.gate_counts(view(spark, sf_dir, "files"))


# Labels


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_join_2022(*_views(spark, sf_dir, "annotations", "images", "categories", "institutions"))


@query
def q_label_join_2022(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir)


@query
def q_label_join_2021(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, images, categories, institutions = _views(
        spark, sf_dir, "annotations", "images21", "categories", "institutions"
    )
    named = institutions.withColumnRenamed("collection_code", "institution_name")
    return labels.label_join_2021(facts, images, categories, named)


@query
def q_fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, images, categories, institutions = _views(
        spark, sf_dir, "annotations_bad", "images", "categories", "institutions"
    )
    return labels.key_violations(
        facts,
        {
            "images": ("image_id", images),
            "categories": ("category_id", categories),
            "institutions": ("institution_id", institutions),
        },
    )


@query
def q_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.last_wins(view(spark, sf_dir, "dim_updates"), "key", ["position"])


@query
def q_caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.with_names(_joined(spark, sf_dir)).select("id", "caption", "scientific_name")


@query
def q_label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_codes(labels.with_names(_joined(spark, sf_dir)))


@query
def q_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.with_split(staged(_joined(spark, sf_dir).select("id"), "ids"))


@query
def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir).select("id", "image_id", "filename").orderBy("id").limit(5)


# Attempts


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "attempts")


@query
def q_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.classified(_attempts(spark, sf_dir)).select("attempt_id", "outcome")


@query
def q_link_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.invalid_links(_attempts(spark, sf_dir)).select("attempt_id", "url", "content_type")


@query
def q_retry_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(log.retry_seconds(_attempts(spark, sf_dir)), "seconds")


@query
def q_host_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.host_errors(_attempts(spark, sf_dir))


@query
def q_top_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.top_hosts(log.host_errors(_attempts(spark, sf_dir)))


@query
def q_breaker_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.breaker_state(_attempts(spark, sf_dir))


@query
def q_breaker_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.broken_hosts(log.host_errors(_attempts(spark, sf_dir)))


@query
def q_cooldown_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.observed_cooldown(_attempts(spark, sf_dir))


@query
def q_guard_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guard.guard_replay(_attempts(spark, sf_dir))


@query
def q_first_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.first_success(_attempts(spark, sf_dir)).select("gbif_id", "attempt_id")


@query
def q_final_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The stand-in decode result: every 29th attempt brought an unreadable image.
    return log.state_totals(log.final_states(_attempts(spark, sf_dir), F.col("attempt_id") % 29 != 0))


@query
def q_milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.milestones(log.first_success(_attempts(spark, sf_dir)), MILESTONE_EVERY)


# Candidates


@query
def q_manifest_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.manifest_urls(view(spark, sf_dir, "manifests"))


@query
def q_expand_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.expanded(*_views(spark, sf_dir, "multimedia", "manifests"))


@query
def q_candidate_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.ordered_candidates(staged(q_expand_candidates(spark, sf_dir), "candidates"))


# Images


@query
def q_fit_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.col("w"), F.col("h")
    fitted = view(spark, sf_dir, "dims").select(
        "image_id",
        fit_edge(w, w, h, STORE_BOX).alias("new_w"),
        fit_edge(h, w, h, STORE_BOX).alias("new_h"),
        "w",
        "h",
        "fmt",
    )
    changed = (F.col("new_w") != w) | (F.col("new_h") != h) | (F.col("fmt") != "JPEG")
    return fitted.select("image_id", "new_w", "new_h", changed.alias("changed"))


@query
def q_psnr(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = view(spark, sf_dir, "pixels")
    name = F.concat(F.col("vec_id").cast("string"), F.lit(".png"))
    originals = pixels.select(name.alias("name"), "px")
    copies = pixels.select(F.concat(F.lit(quality.COPY_MARK), name).alias("name"), F.col("px2").alias("px"))
    measured = quality.with_psnr(quality.paired(originals, copies))
    vec_id = F.regexp_extract("name", "^([0-9]+)", 1).cast("bigint")
    return _rounded(measured.select(vec_id.alias("vec_id"), "mse", "psnr", "identical"), "mse", "psnr")
