"""Daily card feeds: the standard one and the detailed one."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.config import RunContext
from cardloom.functions.joins import in_ranges, key_ranges, union_all
from cardloom.operators.card import attach_time, card_feed, enrich_card, unlogged_rows
from cardloom.operators.incremental import (
    append_load_date,
    backfill_history,
    eligible_history,
    exclude_logged,
    incremental_append,
    is_purge_day,
    log_like,
    newly_eligible,
    purge,
    save_eligible_flag,
    snapshot_overwrite,
)
from cardloom.plans.run_log import Deliver, deliver_logged
from cardloom.sources.files import export_feed
from cardloom.sources.publish import publish
from cardloom.sources.tables import append_run, empty_staged, refuse_repeat, staged, write_version


@dataclass(frozen=True)
class CardTables:
    """Inputs of both card feeds; ``customers`` is the customer feed table.

    Row logs have a row per delivered row, or are kept as runs of rows; a run appends to a log in its own form.
    """

    debit_holding: DataFrame
    credit_holding: DataFrame
    debit_history: DataFrame
    credit_history: DataFrame
    times: DataFrame
    customers: DataFrame
    archive: DataFrame
    merchants: DataFrame
    periods: DataFrame
    mcc: DataFrame
    row_log: DataFrame
    detailed_row_log: DataFrame | None = None
    extra_backfill: DataFrame | None = None


def eligible_customers(t: CardTables, run: RunContext) -> DataFrame:
    return newly_eligible(t.customers, t.archive, run.as_of)


def backfill_rows(t: CardTables, run: RunContext, eligible: DataFrame) -> DataFrame:
    """History of newly eligible customers that the standard feed has not delivered."""
    return backfill_history(t.debit_history, t.credit_history, eligible, [t.row_log], run.as_of)


def run_backfill(t: CardTables, run: RunContext, eligible: DataFrame, stage) -> DataFrame:
    """The same rows, with the history cut to the ranges of the customers and the log to the file ranges of that history."""
    theirs = stage(eligible_history(t.debit_history, t.credit_history, eligible, run.as_of, prune_ids=True), "history")
    return stage(exclude_logged(theirs, in_ranges(t.row_log, "FileID", key_ranges(theirs, "FileID"))), "backfill")


def times_of(t: CardTables, backfill: DataFrame) -> DataFrame:
    """The times of the files that staged rows or the backfill come from."""
    staging = union_all(t.debit_holding.select("FileID"), t.credit_holding.select("FileID"))
    return in_ranges(t.times, "FileID", [*key_ranges(staging, "FileID"), *key_ranges(backfill, "FileID")])


def standard_rows(t: CardTables, backfill: DataFrame, prune_by: str | None = None) -> DataFrame:
    """New and backfilled rows of the standard feed.

    The two are put together before the time and the dimensions are joined, so the
    transactions and the time table pass through each join once.
    """
    fresh = unlogged_rows(t.debit_holding, t.credit_holding, [t.row_log], backfill, prune_by)
    timed = attach_time(union_all(fresh, backfill), t.times)
    return enrich_card(timed, t.customers, t.merchants, t.periods, t.mcc)


def detailed_rows(t: CardTables, backfill: DataFrame, prune_by: str | None = None) -> DataFrame:
    """Rows of the detailed feed, with the time as it is.

    New rows are checked against this feed's own log only, so a row can be both new
    and backfilled; the programme flag is asked of backfilled rows only.  Rows of the
    extra source come without a time.
    """
    fresh = unlogged_rows(t.debit_holding, t.credit_holding, [t.detailed_row_log], prune_by=prune_by)
    rows = union_all(
        fresh.withColumn("IsBackfill", F.lit(False)),
        backfill.withColumn("IsBackfill", F.lit(True)),
    )
    rows = attach_time(rows, t.times, round_down=False)
    if t.extra_backfill is not None:
        extra = exclude_logged(t.extra_backfill, t.detailed_row_log, t.row_log, backfill, prune_by=prune_by)
        rows = union_all(rows, extra.withColumn("IsBackfill", F.lit(True)))
    return enrich_card(rows, t.customers, t.merchants, t.periods, t.mcc, in_program_for="backfill")


def run_card_feed(
    spark: SparkSession,
    t: CardTables,
    run: RunContext,
    out: str,
    detailed: bool = False,
    rows_per_file: int = 2_000_000,
    work: str | None = None,
    deliver: Deliver | None = None,
) -> dict[str, str]:
    """One run of a card feed; returns the paths of the new table versions.

    The backfill and the enriched rows each feed several outputs and are written
    once.  The row log comes last: a run that fails before is repeated in full, and a
    run that is in the log is not repeated at all.  Readers of several outputs ask the manifest under ``published``.  ``deliver`` sends the files off; if its output
    tells of an error, the lines and a summary are kept and the rows are not logged.
    """
    name = "detailed" if detailed else "standard"
    log_path = f"{out}/{name}_row_log"
    refuse_repeat(spark, log_path, run.run_id)
    stage = lambda df, what: staged(df, f"{name}-{what}", run.run_id, work)
    eligible = stage(eligible_customers(t, run), "eligible")
    backfill = run_backfill(t, run, eligible, stage)
    make_rows = detailed_rows if detailed else standard_rows
    rows = stage(make_rows(replace(t, times=times_of(t, backfill)), backfill, prune_by="FileID"), "rows")

    feed = card_feed(rows, run.as_of, detailed=detailed)
    paths = {"feed": export_feed(feed, f"{out}/{name}_feed/run={run.run_id}", run.load_date, rows_per_file)}
    deliver_logged(spark, deliver, paths["feed"], 2 if detailed else 1, run, out, work)
    if detailed:
        paths["eligible_flag"] = write_version(save_eligible_flag(eligible), f"{out}/eligible_flag", run.run_id)
    else:
        dates = spark.createDataFrame([], "LoadDate date")
        append_run(append_load_date(dates, run.as_of), f"{out}/load_dates", run.run_id)
        paths["archive"] = write_version(snapshot_overwrite(t.customers), f"{out}/archive", run.run_id)
        if is_purge_day(run.as_of):
            for kind, table in (("debit_holding", t.debit_holding), ("credit_holding", t.credit_holding)):
                paths[kind] = write_version(purge(table), f"{out}/{kind}", run.run_id)
    # The files are complete: one manifest makes them visible together, and the log says that they are delivered.
    publish(spark, f"{out}/published/{name}", run.run_id, paths, again=True)
    append_run(log_like(t.detailed_row_log if detailed else t.row_log, rows), log_path, run.run_id)
    empty_staged(spark, f"{name}-", run.run_id, work)
    return paths


@dataclass(frozen=True)
class StagingTables:
    """Transactions of the warehouse and what has been staged so far."""

    debit: DataFrame
    credit: DataFrame
    staged_debit: DataFrame
    staged_credit: DataFrame


def run_staging(t: StagingTables, run: RunContext, out: str) -> dict[str, str]:
    """Append the warehouse rows that are not staged yet, debit as payment type 1 and credit as 2."""
    paths = {}
    for kind, number in (("debit", 1), ("credit", 2)):
        source, target = getattr(t, kind), getattr(t, f"staged_{kind}")
        fresh = incremental_append(source, target, consts={"PaymentTypeID": number}, prune_by="FileID")
        paths[kind] = f"{out}/staged_{kind}"
        append_run(fresh, paths[kind], run.run_id)
    return paths
