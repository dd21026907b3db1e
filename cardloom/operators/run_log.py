"""Run logs: error flags, error summaries and left-over lines."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions.compat import has_error_text
from cardloom.functions.joins import semi, with_group_values


def flag_error_runs(log: DataFrame) -> DataFrame:
    """Every line with the error flag of its run.

    The flag per run is aggregated before the shuffle and joined back; a run of any
    length never sits in one task.
    """
    return with_group_values(log, ["RunID"], ["LogID"], isError=F.max(has_error_text("Msg")))


def error_summary(
    flagged: DataFrame,
    pointer: str = "... see the run log of run {run} for more info",
    max_len: int = 1999,
    block: int = 1_000_000,
) -> DataFrame:
    """Last part of the text of each failed run, followed by a pointer, ``max_len`` characters in all.

    Lines are joined with spaces in LogID order; NULL lines are left out.  Every
    line adds at least its space, so the last ``max_len`` lines hold all the text
    needed.  Counts per block of line numbers find the blocks these lines are in,
    and only those are read into a run's text: at most ``max_len`` plus one block.
    """
    lines = flagged.where(F.col("isError") & F.col("Msg").isNotNull()).withColumn(
        "_block", F.floor(F.col("LogID") / block)
    )
    after = Window.partitionBy("RunID").orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    needed = (
        lines.groupBy("RunID", "_block")
        .count()
        .withColumn("_after", F.coalesce(F.sum("count").over(after), F.lit(0)))
        .where(F.col("_after") < max_len)
    )
    last = Window.partitionBy("RunID").orderBy(F.col("LogID").desc())
    tail = semi(lines, needed, ["RunID", "_block"]).withColumn("_place", F.row_number().over(last))
    tail = tail.where(F.col("_place") <= max_len)
    end = F.replace(F.lit(pointer), F.lit("{run}"), F.col("RunID").cast("string"))
    room = F.lit(max_len) - F.length(end)
    in_order = F.expr("listagg(Msg, ' ') WITHIN GROUP (ORDER BY LogID)")
    joined = tail.groupBy("RunID").agg(in_order.alias("_text"))
    whole = joined.withColumns({"_end": end, "_room": room})
    return whole.select("RunID", F.concat(F.right("_text", "_room"), "_end").alias("Summary"))


def residual_lines(log: DataFrame, ignore: Sequence[str], as_of: datetime) -> DataFrame:
    """Lines that are neither NULL nor one of the expected ones, with the date of the run."""
    left_over = log.where(F.col("Msg").isNotNull() & ~F.col("Msg").isin(list(ignore)))
    return left_over.select(F.lit(as_of.date()).alias("TranDate"), F.col("Msg").alias("line"))


def append_run_log(log: DataFrame, flagged: DataFrame, as_of: datetime) -> DataFrame:
    """The permanent run log with the flagged lines of new runs added."""
    lines = flagged.withColumn("CreatedDateTime", F.lit(as_of).cast("timestamp_ntz"))
    return log.unionByName(lines.select(*log.columns))
