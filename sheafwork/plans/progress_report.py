"""Progress report of a collection run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from ..operators.evidence import id_evidence
from ..operators.progress import report_lines, state_counts
from ..sinks.report import write_report
from ..sources.idlist import read_lines
from ..sources.tsv import read_catalogue
from ..staging import pinned
from .acquire import DONE_LIST, FAILED_LIST


def write(spark: SparkSession, catalogue_path: str, status_dir: str, output_dir: str, run_time: datetime) -> str:
    """Compare the id lists with the catalogue; returns the path of the report."""
    evidence = id_evidence(
        read_catalogue(spark, catalogue_path, ["gbifID", "identifier"]),
        read_lines(spark, f"{status_dir}/{DONE_LIST}"),
        read_lines(spark, f"{status_dir}/{FAILED_LIST}"),
    )
    # A few rows per list length; pinned so that the catalogue is read once for all figures.
    states = pinned(state_counts(evidence))
    lines = report_lines(states, run_time.strftime("%Y-%m-%d %H:%M:%S"), status_dir, output_dir)
    return write_report(lines, output_dir, run_time)
