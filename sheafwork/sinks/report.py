"""Text report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

# Fixed value: name of the report.
NAME = "summary_%Y%m%d%H%M.txt"


def write_report(lines: DataFrame, output_dir: str, run_time: datetime) -> str:
    """Write ``line_no, line`` rows, one report per run; returns where it went.

    A report has some sixty lines and one per list length, so it is one file.
    """
    path = f"{output_dir.rstrip('/')}/{run_time.strftime(NAME)}"
    lines.coalesce(1).sortWithinPartitions("line_no").select("line").write.text(path)
    return path
