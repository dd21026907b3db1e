"""What follows an export: the console output of the delivery becomes log lines, and errors stop the run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cardloom.config import RunContext
from cardloom.operators.run_log import append_run_log, error_summary, flag_error_runs, residual_lines
from cardloom.sources.files import read_run_output
from cardloom.sources.tables import append_run, staged

#: Delivers exported files and returns the folder of its console output.
Deliver = Callable[[str], str]
LINES = "RunID int, LogID long, Msg string, isError boolean, CreatedDateTime timestamp_ntz"


class ExportFailed(RuntimeError):
    """The last part of what a failed delivery said."""


def log_delivery(
    spark: SparkSession,
    output: str,
    number: int,
    run: RunContext,
    out: str,
    expected: Sequence[str] = (),
    work: str | None = None,
) -> None:
    """Log the lines of one delivery under ``out`` and raise ``ExportFailed`` if they tell of an error.

    Flagged lines, lines that were not expected, and the summary of a failure are written first.
    """
    lines = read_run_output(spark, output, number)
    flagged = staged(flag_error_runs(lines), f"delivery-{number}", run.run_id, work)
    key = f"{run.run_id}-{number}"
    empty = spark.createDataFrame([], LINES)
    append_run(append_run_log(empty, flagged, run.as_of), f"{out}/run_log", key)
    append_run(residual_lines(flagged, expected, run.as_of), f"{out}/left_over_lines", key)
    if flagged.where(F.col("isError")).limit(1).count():
        summary = error_summary(flagged)
        append_run(summary, f"{out}/error_summaries", key)
        first = summary.first()
        raise ExportFailed(first["Summary"] if first else f"run {number} failed")


def deliver_logged(
    spark: SparkSession, deliver: Deliver | None, path: str, number: int, run: RunContext, out: str, work: str | None = None
) -> None:
    """Deliver exported files and log it; nothing to do without ``deliver``."""
    if deliver is not None:
        log_delivery(spark, deliver(path), number, run, out, work=work)
