"""Outcome of an attempt and the cooldown it asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cooldown seconds for a rate limit without a usable header and for a timeout.
RATE_LIMIT_SECONDS = 1800
TIMEOUT_SECONDS = 3600
# Fixed value: errors at which a host is no longer asked.
BREAKER_ERRORS = 50
# Content types that are not an image, looked for anywhere in the lower-cased header.
DENIED_TYPES = ("text/html", "text/plain", "application/xml")
# Fixed value: the one content type the link check takes as valid.
LINK_CHECK_TYPE = "image/jpeg"

# Never again: end times are micros in 64 bits, and no wait can be longer than this many seconds.
LONGEST_WAIT = 9 * 10**12
# The forms of a date, behind a weekday, with a name or an offset as zone.
DATE_FORMS = tuple(
    f"{day} {time} {zone}" for day in ("d MMM yy", "d MMM yyyy") for time in ("HH:mm:ss", "HH:mm") for zone in ("z", "xx")
)
MICROS = 1_000_000

ACCEPTED = ("ok", "ok_untyped")
ERRORS = ("server_error", "http_error", "bad_type", "exception")
COOLING = ("rate_limit", "timeout")


def outcome(status: Column, error_kind: Column, content_type: Column) -> Column:
    """Class of one attempt; the first matching rule wins."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    denied = F.lit(False)
    for text in DENIED_TYPES:
        denied = denied | kind.contains(text)
    return (
        F.when(error_kind == "timeout", "timeout")
        .when(error_kind.isNotNull() | status.isNull(), "exception")
        .when(status == 429, "rate_limit")
        .when(status >= 500, "server_error")
        .when(status != 200, "http_error")
        .when(kind == "", "ok_untyped")
        .when(denied, "bad_type")
        .otherwise("ok")
    )


def is_error(outcome_col: Column) -> Column:
    """Rate limits and timeouts are no errors: they cool the host down instead."""
    return outcome_col.isin(*ERRORS)


def is_accepted(outcome_col: Column) -> Column:
    return outcome_col.isin(*ACCEPTED)


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Micros since the epoch; a timestamp without zone is read as UTC whatever the session zone."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.unix_micros(F.from_utc_timestamp(F.col(name).cast("timestamp"), F.current_timezone()))
    return F.unix_micros(F.col(name))


def cooldown_micros(outcome_col: Column, retry_after: Column, ts_us: Column) -> Column:
    """Micros a host has to rest after this attempt, null when the attempt asks for no rest.

    A rate limit names whole seconds or an HTTP date; anything else means the default. Whole numbers
    beyond 64 bits mean never again. A timeout always means its own default.
    """
    text = F.trim(retry_after)
    beyond = F.when(text.rlike("^[+]?[0-9]+$"), LONGEST_WAIT).when(text.rlike("^-[0-9]+$"), -LONGEST_WAIT)
    seconds = F.coalesce(retry_after.try_cast("bigint"), beyond.cast("bigint"))
    # The weekday is taken off first: its pattern letter is refused by the Spark 3+ parser.
    plain = F.regexp_replace(F.regexp_replace(retry_after, r"^\s*[A-Za-z]{3,9},\s*", ""), r"^(\d+)-([A-Za-z]+)-(\d+)", "$1 $2 $3")
    date_us = F.unix_micros(F.coalesce(*[F.try_to_timestamp(plain, F.lit(form)) for form in DATE_FORMS]))
    longest = F.lit(LONGEST_WAIT)
    # least and greatest pass over nulls, so each is asked only when its column is there.
    named = (
        F.when(seconds.isNotNull(), F.greatest(F.least(seconds, longest), -longest) * MICROS)
        .when(date_us.isNotNull(), F.greatest(date_us - ts_us, F.lit(0).cast("bigint")))
        .otherwise(F.lit(RATE_LIMIT_SECONDS * MICROS).cast("bigint"))
    )
    return F.when(outcome_col == "rate_limit", named).when(
        outcome_col == "timeout", F.lit(TIMEOUT_SECONDS * MICROS).cast("bigint")
    )
