"""Incremental loading and delivery state.

Delivery state is a log of row keys (FileID, RowNum).  A table is never updated in
place: each function returns the new rows or the new state, and the caller writes it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.config import load_date
from cardloom.functions.joins import anti, in_ranges, key_ranges, semi, union_all, within
from cardloom.operators.row_runs import exclude_runs, holds_runs, row_runs

ROW_KEY = ("FileID", "RowNum")


def exclude_logged(
    df: DataFrame,
    *logs: DataFrame,
    keys: Sequence[str] = ROW_KEY,
    prune_by: str | None = None,
    colocated: bool = False,
) -> DataFrame:
    """Rows whose key is in none of the logs.

    All logs go into one anti join, so ``df`` is shuffled once however many there
    are.  A log keeps every row ever delivered; ``prune_by`` names a key column that
    rises over time, such as the file id, and cuts the logs to its range in ``df``
    before they are shuffled (two scalars, no join).  Logs kept as runs of rows
    (:mod:`cardloom.operators.row_runs`) are told by their columns and need the row key as ``keys``.
    ``colocated`` is for logs in buckets of the key (``write_bucketed``): each is joined as it lies, since a union of
    them would have to be shuffled.
    """
    cut = list(logs) if prune_by is None else [within(log, df, prune_by) for log in logs]
    runs, rows = [log for log in cut if holds_runs(log)], [log for log in logs if not holds_runs(log)]
    if runs:
        df = exclude_runs(df, *runs)
    if colocated:
        for log in rows:
            df = anti(df, log if prune_by is None else within(log, df, prune_by), keys)
        return df
    if not rows:
        return df
    seen = union_all(*[log.select(*keys) for log in rows])
    return anti(df, seen if prune_by is None else within(seen, df, prune_by), keys)


def incremental_append(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str] = ROW_KEY,
    consts: Mapping[str, int] | None = None,
    prune_by: str | None = None,
) -> DataFrame:
    """Rows to append to ``target``: source rows not there yet, plus constant columns."""
    fresh = exclude_logged(source, target, keys=keys, prune_by=prune_by)
    return fresh.withColumns({name: F.lit(value).cast("int") for name, value in (consts or {}).items()})


def log_rows(*delivered: DataFrame, processed_at: datetime | None = None) -> DataFrame:
    """Log entries of delivered rows, one per row."""
    rows = union_all(*[d.select(*ROW_KEY) for d in delivered])
    if processed_at is None:
        return rows
    return rows.withColumn("ProcessedDate", F.lit(processed_at).cast("timestamp_ntz"))


def log_like(log: DataFrame, *delivered: DataFrame) -> DataFrame:
    """Log entries of delivered rows in the form of ``log``: rows, or runs of rows."""
    return row_runs(*delivered) if holds_runs(log) else log_rows(*delivered)


def append_row_log(log: DataFrame, *delivered: DataFrame, processed_at: datetime | None = None) -> DataFrame:
    """The log after a delivery."""
    return log.unionByName(log_rows(*delivered, processed_at=processed_at))


def append_load_date(log: DataFrame, as_of: datetime) -> DataFrame:
    """The load-date log with the business date of this run added."""
    spark = log.sparkSession
    today = spark.range(1).select(F.lit(load_date(as_of)).alias("LoadDate"))
    return log.select("LoadDate").unionByName(today)


def last_load_date(log: DataFrame, as_of: datetime) -> DataFrame:
    """Latest load date before the day of the run."""
    before = log.where(F.col("LoadDate") < F.lit(as_of.date()))
    return before.agg(F.max("LoadDate").alias("LastLoadDate"))


def newly_eligible(customers: DataFrame, archive: DataFrame, as_of: datetime) -> DataFrame:
    """Distinct ids in the programme but not in the last snapshot, or registered within a month."""
    known = archive.select("cinid").distinct().withColumn("_known", F.lit(True))
    joined_lately = F.col("RegistrationDate") > F.add_months(F.lit(as_of.date()), -1)
    arrived = (F.col("inprogram") == 1) & F.col("_known").isNull()
    return customers.join(known, "cinid", "left").where(arrived | joined_lately).select("cinid").distinct()


def history_start(as_of: datetime, years: int = 5) -> date:
    """First day of the month of the run, some years earlier; history starts the day after."""
    return date(as_of.year - years, as_of.month, 1)


def eligible_history(debit: DataFrame, credit: DataFrame, eligible: DataFrame, as_of: datetime, prune_ids: bool = False) -> DataFrame:
    """History of newly eligible customers: debit as type 1, credit as type 2.

    The date bound is a literal, so it prunes partitions and reaches the scan.  ``prune_ids`` adds the ranges of the ids, at
    most 64, as literals: of a history in order of customers (``write_clustered``) a handful of customers then
    reads a handful of row groups.  It runs a small job over ``eligible``, which should be stored.
    """
    both = union_all(
        debit.withColumn("PaymentTypeID", F.lit(1)),
        credit.withColumn("PaymentTypeID", F.lit(2)),
    )
    recent = both.where(F.col("TranDate") > F.lit(history_start(as_of)))
    if prune_ids:
        recent = in_ranges(recent, "CINID", key_ranges(eligible, "cinid"))
    return semi(recent, eligible.select(F.col("cinid").alias("CINID")), ["CINID"])


def backfill_history(
    debit: DataFrame,
    credit: DataFrame,
    eligible: DataFrame,
    logs: Sequence[DataFrame],
    as_of: datetime,
    prune_by: str | None = None,
) -> DataFrame:
    """The same rows where they have not been delivered.

    A backfill spans years, so the range of ``prune_by`` cuts little of the logs; a run
    stages :func:`eligible_history` and cuts the logs to its file ranges.
    """
    return exclude_logged(eligible_history(debit, credit, eligible, as_of), *logs, prune_by=prune_by)


def append_extra_backfill(
    backfill: DataFrame, extra: DataFrame, logs: Sequence[DataFrame], prune_by: str | None = None
) -> DataFrame:
    """The backfill plus rows of a further source that are neither logged nor in it already."""
    return union_all(backfill, exclude_logged(extra, *logs, backfill, prune_by=prune_by))


def snapshot_overwrite(customers: DataFrame) -> DataFrame:
    """The ids in the programme: next run's archive."""
    return customers.where(F.col("inprogram") == 1).select("cinid")


def save_eligible_flag(eligible: DataFrame) -> DataFrame:
    """Eligible ids as the flag table that the customer feed reads."""
    return eligible.select("cinid")


def purge(table: DataFrame) -> DataFrame:
    """The table with its columns and no rows."""
    return table.where(F.lit(False))


SATURDAY = 6


def is_purge_day(as_of: datetime, weekday: int = SATURDAY) -> bool:
    """Whether the run date falls on the given day of the week, Monday being 1, in any locale."""
    return as_of.isoweekday() == weekday


def purge_on_weekday(table: DataFrame, as_of: datetime, weekday: int = SATURDAY) -> DataFrame:
    """Empty on the given weekday of the run date, unchanged otherwise."""
    return purge(table) if is_purge_day(as_of, weekday) else table
