"""Card transaction feeds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.config import load_date
from cardloom.functions.compat import half_hour
from cardloom.functions.joins import binned, hot_keys, salted_join, union_all, within
from cardloom.functions.keys import tran_sequence_id, without_commas
from cardloom.operators.incremental import ROW_KEY, exclude_logged

# Fixed value: a subscription period without an end runs to this day.
OPEN_END = date(2100, 1, 1)


def attach_time(
    tx: DataFrame,
    times: DataFrame,
    keys: Sequence[str] = ROW_KEY,
    round_down: bool = True,
    prune_by: str | None = None,
) -> DataFrame:
    """Transactions with the time of day, rounded down to the half hour unless told otherwise.

    Joined on the row key, like the log, so that Spark reuses one shuffle for both.
    ``prune_by`` cuts the times, which keep every row ever loaded, to the range of the batch.
    """
    known = times.select(*keys, "TranTime")
    if prune_by is not None:
        known = within(known, tx, prune_by)
    timed = tx.join(known, list(keys), "left").select(*tx.columns, "TranTime")
    return timed.withColumn("TranTime", half_hour("TranTime")) if round_down else timed


def unlogged_rows(
    debit: DataFrame,
    credit: DataFrame,
    logs: Sequence[DataFrame],
    backfill: DataFrame | None = None,
    prune_by: str | None = None,
) -> DataFrame:
    """Staged rows not delivered yet and, where a backfill is given, not in it."""
    staged = union_all(
        debit.withColumn("PaymentTypeID", F.lit(1)),
        credit.withColumn("PaymentTypeID", F.lit(2)),
    )
    known = [*logs, backfill] if backfill is not None else list(logs)
    return exclude_logged(staged, *known, prune_by=prune_by)


def select_new(
    debit: DataFrame,
    credit: DataFrame,
    times: DataFrame,
    logs: Sequence[DataFrame],
    backfill: DataFrame | None = None,
    round_down: bool = True,
    prune_by: str | None = None,
) -> DataFrame:
    """The same rows with their time of day."""
    rows = unlogged_rows(debit, credit, logs, backfill, prune_by)
    if prune_by is not None:
        # All staged rows have the range of the new ones or a wider one, and cost no join to look at.
        times = within(times, union_all(debit.select(prune_by), credit.select(prune_by)), prune_by)
    return attach_time(rows, times, round_down=round_down)


def subscription_flag(tx: DataFrame, periods: DataFrame, period_bin: str | None = None) -> DataFrame:
    """Left join to the price periods of the brand; flag 1 when the amount and day fit one.

    Brand and exact amount are the hash keys, the half-open date range a residual
    condition.  A transaction in two overlapping periods comes out twice.  Where a price has very many periods,
    ``period_bin`` ("week", "month", "year") adds the bin of the day to the keys, see :func:`binned`.
    """
    p = periods.select(
        F.col("BrandID").alias("_brand"),
        F.col("Amount").alias("_amount"),
        F.col("startdate").alias("_start"),
        F.coalesce(F.col("enddate"), F.lit(OPEN_END)).alias("_end"),
    )
    fits = (
        (tx["BrandID"] == p["_brand"])
        & (tx["Amount"] == p["_amount"])
        & (tx["TranDate"] >= p["_start"])
        & (tx["TranDate"] < p["_end"])
    )
    flag = F.when(F.col("_brand").isNull(), 0).otherwise(1)
    if period_bin is None:
        return tx.join(p, fits, "left").select(*tx.columns, flag.alias("subscription_flag"))
    columns, bins = tx.columns, binned(p, "_start", "_end", tx, "TranDate", period_bin, "_period_bin")
    tx = tx.withColumn("_day_bin", F.date_trunc(period_bin, "TranDate").cast("date"))
    same_bin = fits & (F.col("_day_bin") == F.col("_period_bin"))
    return tx.join(bins, same_bin, "left").select(*columns, flag.alias("subscription_flag"))


def enrich_card(
    tx: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    periods: DataFrame,
    mcc: DataFrame,
    publisher: int = 1,
    in_program_for: str = "all",
    rows_per_split: int | None = None,
    period_bin: str | None = None,
) -> DataFrame:
    """Star join of transactions to customer, merchant, category and subscription.

    Rows without a known customer or merchant drop out (and are not logged, so a
    later run tries again).  ``in_program_for`` is "all", or "backfill" to ask the
    programme flag only of rows whose ``IsBackfill`` is true.  The category is
    joined to the merchants first, which saves a join of the transactions.
    Both big joins have plain tables on the right, so adaptive execution splits hot
    customers and merchants; ``rows_per_split`` salts those with more rows than that
    instead, for clusters that run without it.
    """
    people = customers.select(
        F.col("cinid").alias("CINID"), "inprogram", F.col("insight_ageband").alias("currentagebandtext")
    )
    codes = mcc.select("MCCID", F.col("MCC").alias("mcc"))
    shops = (
        merchants.select("ConsumerCombinationID", "BrandID", F.col("MID").alias("mid"), "MCCID")
        .join(codes, "MCCID", "left")
        .drop("MCCID")
    )
    if in_program_for == "all":
        people = people.where(F.col("inprogram") == 1)
    if rows_per_split is None:
        joined = tx.join(people, "CINID").join(shops, "ConsumerCombinationID")
    else:
        by_customer = hot_keys(tx, ["CINID"], rows_per_split)
        by_merchant = hot_keys(tx, ["ConsumerCombinationID"], rows_per_split)
        joined = salted_join(tx, people, ["CINID"], "inner", ROW_KEY, by_customer)
        joined = salted_join(joined, shops, ["ConsumerCombinationID"], "inner", ROW_KEY, by_merchant)
    if in_program_for == "backfill":
        joined = joined.where(~F.col("IsBackfill") | (F.col("inprogram") == 1))
    return subscription_flag(joined, periods, period_bin).select(
        *tx.columns,
        "BrandID",
        "subscription_flag",
        "mcc",
        "mid",
        "currentagebandtext",
        F.lit(publisher).alias("publisherid"),
        tran_sequence_id(publisher, "FileID", "RowNum").alias("TranSequenceID"),
    )


FEED_COLUMNS = (
    "TranSequenceID",
    "ConsumerCombinationID",
    "CardholderPresentData",
    "CINID",
    "Amount",
    "IsOnline",
    "PaymentTypeID",
    "TranDate",
    "BrandID",
    "subscription_flag",
    "publisherid",
    "mcc",
    "mid",
    "currentagebandtext",
    "TranTime",
)


def card_feed(enriched: DataFrame, as_of: datetime, detailed: bool = False) -> DataFrame:
    """The feed table: update type and business date added.

    The first feed strips commas from the MID; the detailed one leaves it alone and
    keeps the row key and the input mode.
    """
    day = F.lit(load_date(as_of))
    columns = [*ROW_KEY, *FEED_COLUMNS, "InputModeID"] if detailed else list(FEED_COLUMNS)
    feed = enriched.select(*columns)
    if not detailed:
        feed = feed.withColumn("mid", without_commas("mid"))
    return feed.withColumns({"UpdateType": F.lit("N"), "UpdateDate": day, "LoadDate": day})
