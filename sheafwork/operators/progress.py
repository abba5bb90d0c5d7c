"""Progress of a collection run and its text report."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .evidence import listed


def state_counts(evidence: DataFrame) -> DataFrame:
    """Ids by (in catalogue, list length, done, failed): a small table all figures come from."""
    return evidence.groupBy(
        listed().alias("listed"), F.col("id").isNull().alias("no_id"), "n_urls", "done", "failed"
    ).agg(F.count("*").alias("n_ids"))


def _ids(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n_ids"))), F.lit(0)).cast("bigint")


def _urls(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n_ids") * F.col("n_urls"))), F.lit(0)).cast("bigint")


def totals(states: DataFrame) -> DataFrame:
    """One row with every figure of the report."""
    here, done, failed = F.col("listed"), F.col("done"), F.col("failed")
    left = here & ~done & ~failed
    return states.agg(
        _urls(F.lit(True)).alias("total_rows"),
        _ids(here).alias("unique_ids"),
        _ids(here & done).alias("processed"),
        _ids(here & failed).alias("failed"),
        _ids(left).alias("remaining"),
        _urls(here & done).alias("urls_processed"),
        _urls(here & failed).alias("urls_failed"),
        _urls(left).alias("urls_remaining"),
        _ids(done).alias("listed_done"),
        _ids(failed).alias("listed_failed"),
        _ids(~here & done).alias("extra_processed"),
        _ids(~here & failed).alias("extra_failed"),
    )


def _ratio(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def _percent(part: str) -> Column:
    return _ratio(part, "unique_ids") * 100


def progress(states: DataFrame) -> DataFrame:
    """Counts and percentages; an id on both lists counts under each, so they may pass 100."""
    return totals(states).select(
        F.col("unique_ids").alias("total_ids"),
        "processed",
        "failed",
        (F.col("processed") + F.col("failed")).alias("attempted"),
        "remaining",
        _percent("processed").alias("pct_processed"),
        _percent("failed").alias("pct_failed"),
        _percent("remaining").alias("pct_remaining"),
    )


def catalogue_stats(states: DataFrame) -> DataFrame:
    return totals(states).select(
        "total_rows",
        "unique_ids",
        _ratio("total_rows", "unique_ids").alias("avg_urls"),
    )


def distribution(states: DataFrame) -> DataFrame:
    """How many ids have how many URLs."""
    return (
        states.filter("listed")
        .groupBy(F.col("n_urls").alias("num_images"))
        .agg(F.sum("n_ids").alias("id_count"))
    )


def urls_by_state(states: DataFrame) -> DataFrame:
    return totals(states).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(state).alias("state"), value.alias("url_count"))
                    for state, value in (
                        ("processed", F.col("urls_processed")),
                        ("failed", F.col("urls_failed")),
                        ("remaining", F.col("urls_remaining")),
                        ("total", F.col("urls_processed") + F.col("urls_failed") + F.col("urls_remaining")),
                    )
                ]
            )
        )
    )


def extra_ids(evidence: DataFrame) -> DataFrame:
    """Ids on a list that the catalogue does not have."""
    lists = F.array_compact(
        F.array(F.when(F.col("done"), F.lit("processed")), F.when(F.col("failed"), F.lit("failed")))
    )
    return evidence.filter(F.col("id").isNotNull() & (F.col("n_urls") == 0)).select(
        F.explode(lists).alias("list_name"), "id"
    )


# Text of the report. Names in braces are filled in.
RULE, SHORT_RULE = "=" * 70, "-" * 35
REPORT_NAME = "summary_{minute}.txt"
REPORT_START = """\
Run date: {run_date}

{rule}
Image Installation Progress Analysis
{rule}

Loading processed and failed IDs...
  Status directory: {status_dir}
  processed_ids.txt: {status_dir}/processed_ids.txt
  failed_ids.txt: {status_dir}/failed_ids.txt
  Processed IDs loaded: {listed_done}
  Failed IDs loaded: {listed_failed}

Loading multimedia.txt (this may take a moment)...
  Total rows in multimedia.txt: {total_rows}

{rule}
OVERALL STATISTICS
{rule}
Total unique gbifIDs in multimedia.txt:  {unique_ids}
Total image URLs in multimedia.txt:      {total_rows}
Average images per gbifID:               {avg_urls}

{rule}
INSTALLATION PROGRESS
{rule}
Successfully processed:                  {processed}
Failed:                                  {failed}
Total attempted (processed + failed):    {attempted}
Remaining (not yet attempted):           {remaining}

Progress:                                {pct_processed}%
Failed:                                  {pct_failed}%
Remaining:                               {pct_remaining}%

{rule}
IMAGES PER GBIFID DISTRIBUTION
{rule}
Number of images | Count of gbifIDs
{short_rule}"""
REPORT_SPREAD = "%16d | {id_count}"
REPORT_MIDDLE = """\

{rule}
IMAGE URL ANALYSIS
{rule}
Image URLs for processed gbifIDs:        {urls_processed}
Image URLs for failed gbifIDs:           {urls_failed}
Image URLs for remaining gbifIDs:        {urls_remaining}
Total:                                   {urls_total}

{rule}
NOTES
{rule}
- Each gbifID may reference multiple image URLs
- The script downloads ONE image per gbifID (trying all URLs until one succeeds)
- 'Processed' means we successfully downloaded at least one image for that ID
- 'Failed' means all image URLs for that ID failed to download
"""
REPORT_WARNING = """\
{rule}
WARNINGS
{rule}"""
REPORT_EXTRA_DONE = "⚠️  {extra_processed} IDs in processed_ids.txt not found in multimedia.txt"
REPORT_EXTRA_FAILED = "⚠️  {extra_failed} IDs in failed_ids.txt not found in multimedia.txt"
REPORT_END = """\
{rule}
Summary written to: {report_path}
{rule}"""


def _filled(text: str, values: dict[str, Column]) -> list[Column]:
    """One column per line of ``text``, names in braces replaced by their columns."""
    lines = []
    for line in text.split("\n"):
        pieces = []
        for literal, name, _, _ in Formatter().parse(line):
            pieces += [F.lit(literal)] if literal else []
            pieces += [values[name]] if name else []
        lines.append(F.concat(*pieces) if pieces else F.lit(""))
    return lines


def report_lines(states: DataFrame, run_time: str, status_dir: str, output_dir: str) -> DataFrame:
    """The report as ``line_no, line``; ``run_time`` is ``yyyy-MM-dd HH:mm:ss`` text."""
    at = F.to_timestamp(F.lit(run_time))
    count = lambda c: F.format_number(c, 0)
    two_places = lambda c: F.coalesce(F.format_string("%.2f", c), F.lit("n/a"))
    figures = totals(states)
    url_total = F.col("urls_processed") + F.col("urls_failed") + F.col("urls_remaining")
    values = {name: count(F.col(name)) for name in figures.columns} | {
        "rule": F.lit(RULE),
        "short_rule": F.lit(SHORT_RULE),
        "status_dir": F.lit(status_dir),
        "run_date": F.date_format(at, "yyyy-MM-dd HH:mm:ss"),
        "minute": F.date_format(at, "yyyyMMddHHmm"),
        "avg_urls": two_places(_ratio("total_rows", "unique_ids")),
        "attempted": count(F.col("processed") + F.col("failed")),
        "urls_total": count(url_total),
        **{f"pct_{part}": two_places(_percent(part)) for part in ("processed", "failed", "remaining")},
    }
    values["report_path"] = F.concat(F.lit(f"{output_dir}/"), *_filled(REPORT_NAME, values))
    extra_done, extra_failed = F.col("extra_processed") > 0, F.col("extra_failed") > 0
    warned = extra_done | extra_failed
    rest = [
        *_filled(REPORT_MIDDLE, values),
        *[F.when(warned, line) for line in _filled(REPORT_WARNING, values)],
        *[F.when(extra_done, line) for line in _filled(REPORT_EXTRA_DONE, values)],
        *[F.when(extra_failed, line) for line in _filled(REPORT_EXTRA_FAILED, values)],
        F.when(warned, F.lit("")),
        *_filled(REPORT_END, values),
    ]

    def numbered(lines: list[Column], section: int) -> list[Column]:
        return [
            F.struct(F.lit(section).alias("section"), F.lit(i).cast("bigint").alias("pos"), line.alias("line"))
            for i, line in enumerate(lines)
        ]

    fixed = figures.select(F.inline(F.array(*numbered(_filled(REPORT_START, values), 0), *numbered(rest, 2))))
    width, tail = REPORT_SPREAD.split(" ", 1)
    spread_line = F.concat(F.format_string(width + " ", "num_images"), *_filled(tail, {"id_count": count(F.col("id_count"))}))
    spread = distribution(states).select(
        F.lit(1).alias("section"), F.col("num_images").alias("pos"), spread_line.alias("line")
    )
    # The report itself: some sixty lines and one per list length.
    in_order = Window.orderBy("section", "pos")
    return (
        fixed.unionByName(spread)
        .filter(F.col("line").isNotNull())
        .select(F.row_number().over(in_order).alias("line_no"), "line")
    )
