"""The attempt log: outcomes, host errors, breaker, cooldowns, first successes, final states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import http
from ..functions.urls import host_of
from .ordered import exact_rank, last_before, running_count

ORDER = ("ts_us", "attempt_id")
# Completions between notifications, between log entries, and between log entries of a resize.
NOTIFY_EVERY, LOG_EVERY = 50_000, 10_000


def classified(attempts: DataFrame) -> DataFrame:
    return attempts.withColumn(
        "outcome", http.outcome(F.col("status"), F.col("error_kind"), F.col("content_type"))
    )


def host_events(attempts: DataFrame) -> DataFrame:
    """The narrow row the host guards work on."""
    micros = http.epoch_micros(attempts, "ts")
    return (
        classified(attempts)
        .select("attempt_id", host_of(F.col("url")).alias("host"), micros.alias("ts_us"), "outcome", "retry_after")
        .select(
            "attempt_id",
            "host",
            "ts_us",
            http.is_error(F.col("outcome")).cast("int").alias("is_error"),
            http.cooldown_micros(F.col("outcome"), F.col("retry_after"), F.col("ts_us")).alias("rest_us"),
        )
    )


def retry_seconds(attempts: DataFrame) -> DataFrame:
    """Seconds of rest asked for by rate limits and timeouts."""
    return (
        host_events(attempts)
        .filter(F.col("rest_us").isNotNull())
        .select("attempt_id", (F.col("rest_us").cast("double") / F.lit(1e6)).alias("seconds"))
    )


def invalid_links(attempts: DataFrame, valid_types: tuple[str, ...] = (http.LINK_CHECK_TYPE,)) -> DataFrame:
    """Answers with status 200 whose content type is not the expected one; a missing type is invalid."""
    return attempts.filter(
        (F.col("status") == 200) & ~F.coalesce(F.col("content_type").isin(*valid_types), F.lit(False))
    )


def link_summary(attempts: DataFrame) -> DataFrame:
    """Checked, invalid and failed links."""
    failed = F.col("error_kind").isNotNull() | (F.col("status") != 200)
    wrong = (F.col("status") == 200) & ~F.col("content_type").eqNullSafe(http.LINK_CHECK_TYPE)
    return attempts.agg(
        F.count("*").alias("checked"), F.count_if(wrong).alias("invalid"), F.count_if(failed).alias("not_answered")
    )


def host_errors(attempts: DataFrame) -> DataFrame:
    """Errors per host; hosts without any are not in the result."""
    failed = classified(attempts).filter(http.is_error(F.col("outcome")))
    return failed.groupBy(host_of(F.col("url")).alias("host")).agg(F.count("*").alias("errors"))


def top_hosts(errors: DataFrame, n: int = 10) -> DataFrame:
    """Hosts with most errors; equal counts are ordered by host."""
    return errors.orderBy(F.desc("errors"), "host").limit(n)


def broken_hosts(errors: DataFrame, threshold: int = http.BREAKER_ERRORS) -> DataFrame:
    return errors.agg(F.count_if(F.col("errors") >= threshold).alias("n_broken"))


def breaker_state(attempts: DataFrame, threshold: int = http.BREAKER_ERRORS) -> DataFrame:
    """Errors of the host before each attempt and whether its breaker is open by then."""
    events = host_events(attempts).select("host", "ts_us", "attempt_id", "is_error")
    counted = running_count(events, "host", ORDER, "is_error", "errors_before")
    return counted.select("attempt_id", "errors_before", (F.col("errors_before") >= threshold).alias("open"))


def observed_cooldown(attempts: DataFrame) -> DataFrame:
    """Whether the host rests at the time of each attempt, every logged attempt taken as sent.

    The latest wish counts, even when it ends sooner than an earlier one.
    """
    events = host_events(attempts).select(
        "host", "ts_us", "attempt_id", (F.col("ts_us") + F.col("rest_us")).alias("until_us")
    )
    seen = last_before(events, "host", ORDER, "until_us", "latest_us")
    return seen.select("attempt_id", F.coalesce(F.col("ts_us") < F.col("latest_us"), F.lit(False)).alias("blocked"))


def first_success(attempts: DataFrame) -> DataFrame:
    """First accepted attempt of each id in candidate order, with its time."""
    micros = http.epoch_micros(attempts, "ts")
    accepted = classified(attempts).filter(http.is_accepted(F.col("outcome"))).withColumn("ts_us", micros)
    pick = F.min_by(F.struct("attempt_id", "ts_us", "url"), F.struct("seq", "attempt_id"))
    return accepted.groupBy("gbif_id").agg(pick.alias("hit")).select("gbif_id", "hit.*")


def final_states(attempts: DataFrame, readable: Column) -> DataFrame:
    """State of each id: done when its first accepted attempt is readable, else failed.

    ``readable`` is a condition on ``attempt_id``. An unreadable image ends the id; later
    candidates are not tried.
    """
    accepted = http.is_accepted(F.col("outcome"))
    hit = F.min_by(F.when(accepted, F.col("attempt_id")), F.when(accepted, F.struct("seq", "attempt_id")))
    ids = classified(attempts).groupBy("gbif_id").agg(hit.alias("attempt_id"))
    done = F.col("attempt_id").isNotNull() & readable
    return ids.select("gbif_id", "attempt_id", F.when(done, "done").otherwise("failed").alias("state"))


def state_totals(states: DataFrame) -> DataFrame:
    return states.groupBy("state").agg(F.count("*").alias("n_ids"))


def milestones(completions: DataFrame, every: int = NOTIFY_EVERY, stored: int = 0) -> DataFrame:
    """Every ``every``-th completion in time order, counting on from ``stored`` files."""
    ranked = exact_rank(completions.select("ts_us", "attempt_id", "gbif_id"), ORDER, "_rank")
    ordinal = F.col("_rank") + F.lit(stored)
    return ranked.withColumn("ordinal", ordinal).filter(F.col("ordinal") % every == 0).select("ordinal", "gbif_id")


def run_milestones(
    completions: DataFrame, planned: int, stored: int = 0, intervals: tuple[int, ...] = (NOTIFY_EVERY, LOG_EVERY)
) -> DataFrame:
    """``every, ordinal, gbif_id, remaining`` for several intervals from one ranking.

    ``planned`` is how many ids the run set out to fetch; ``remaining`` counts those not yet done then.
    """
    ranked = exact_rank(completions.select("ts_us", "attempt_id", "gbif_id"), ORDER, "_rank")
    counted = ranked.withColumn("ordinal", F.col("_rank") + F.lit(stored)).withColumn(
        "every", F.explode(F.array(*[F.lit(n) for n in intervals]))
    )
    reached = counted.filter(F.col("ordinal") % F.col("every") == 0)
    return reached.select("every", "ordinal", "gbif_id", (F.lit(planned) - F.col("_rank")).alias("remaining"))
