"""Quarantine feed: card transactions whose merchant is not known yet."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.config import load_date
from cardloom.functions.bands import AGE_INSIGHT, band
from cardloom.functions.compat import half_hour
from cardloom.functions.joins import anti, semi, union_all, within
from cardloom.functions.keys import card_type, terminal_type, tran_sequence_id, without_commas
from cardloom.operators.incremental import ROW_KEY, exclude_logged

HELD = (
    "FileID",
    "RowNum",
    "CINID",
    "TranDate",
    "MID",
    "MCCID",
    "Narrative",
    "LocationCountry",
    "OriginatorID",
    "Amount",
    "CardholderPresentData",
    "PaymentTypeID",
    "LocationID",
)


def hold_debit(pending: DataFrame, customers: DataFrame, log: DataFrame, prune_by: str | None = None) -> DataFrame:
    """Pending debit rows of known customers that are not logged.

    ``prune_by`` cuts the log to the range of all pending rows, known before the join.
    """
    if prune_by is not None:
        log = within(log, pending, prune_by)
    return exclude_logged(semi(pending.select(*HELD), customers, ["CINID"]), log)


def hold_credit(pending: DataFrame, customers: DataFrame, log: DataFrame, prune_by: str | None = None) -> DataFrame:
    """Pending credit rows joined to preferred customers, minus the log.

    An inner join: a card id held by two customers gives the row twice.  Two columns
    take their debit names.
    """
    if prune_by is not None:
        log = within(log, pending, prune_by)
    known = customers.where(F.col("rw") == 1).select("CINID")
    named = pending.withColumnsRenamed(
        {"OriginatorReference": "OriginatorID", "CardholderPresentMc": "CardholderPresentData"}
    )
    return exclude_logged(named.select(*HELD).join(known, "CINID").select(*HELD), log)


def normalise_quarantine(
    debit: DataFrame,
    credit: DataFrame,
    customers: DataFrame,
    mcc: DataFrame,
    times: DataFrame,
    prune_by: str | None = None,
) -> DataFrame:
    """Held debit and credit rows in one shape, with customer, category and time.

    Both kinds follow the same rules, so they are put together before the joins.
    """
    people = customers.where(F.col("rw") == 1).select(
        "CINID", "FanID", "SourceUID", "PostalArea", "PostcodeDistrict"
    )
    codes = mcc.select("MCCID", "MCC")
    clock = times.select(*ROW_KEY, half_hour("TransactionTime").alias("TranTime"))
    held = union_all(debit.select(*HELD), credit.select(*HELD))
    if prune_by is not None:
        clock = within(clock, held, prune_by)
    return (
        held.join(clock, list(ROW_KEY), "left")
        .join(people, "CINID")
        .join(codes, "MCCID")
        .select(
            "FileID",
            "RowNum",
            F.lit(None).cast("int").alias("ConsumerCombinationID"),
            "CardholderPresentData",
            "TranDate",
            "Amount",
            "FanID",
            "CINID",
            F.lit("GBP").alias("CurrencyCode"),
            F.col("CardholderPresentData").alias("CardholderPresentFlag"),
            card_type("PaymentTypeID").alias("CardType"),
            F.col("PostalArea").alias("CardholderPostalArea"),
            "SourceUID",
            F.col("PostcodeDistrict").alias("CardholderPostcodeDistrict"),
            tran_sequence_id(1, "FileID", "RowNum").alias("TransSequenceID"),
            "OriginatorID",
            "LocationCountry",
            "Narrative",
            "MCCID",
            "LocationID",
            without_commas("MID").alias("MID"),
            "MCC",
            "TranTime",
        )
    )


def quarantine_feed(
    normalised: DataFrame,
    id_map: DataFrame,
    customers: DataFrame,
    locations: DataFrame,
    merchant_zips: DataFrame,
    duplicate_cins: DataFrame,
    unbranded_brand: int,
    as_of: datetime,
) -> DataFrame:
    """The quarantine feed: active, non-duplicate customers, with place and terminal type.

    Customer conditions are settled on the customer table before the transactions
    are joined to it.
    """
    active = customers.where(F.col("CurrentlyActive")).select(
        F.col("SourceUID").alias("CIN"), "FanID", "AgeCurrent"
    )
    people = anti(active, duplicate_cins, ["CIN", "FanID"])
    people = people.join(id_map.select("CIN", "CINID"), "CIN").select(
        "CINID", band("AgeCurrent", AGE_INSIGHT).alias("currentagebandtext")
    )
    places = locations.select("LocationID", "LocationAddress")
    zips = merchant_zips.select(F.col("merchantid").alias("MID"), "merchantzip")
    day = F.lit(load_date(as_of))
    return (
        normalised.join(people, "CINID")
        .join(places, "LocationID", "left")
        .join(zips, "MID", "left")
        .select(
            "TransSequenceID",
            "CINID",
            "TranDate",
            "MCC",
            without_commas("Narrative").alias("MerchantNarrative"),
            F.col("LocationCountry").alias("CountryCode"),
            F.col("LocationAddress").alias("MerchantLocation"),
            F.col("merchantzip").alias("MerchantPostcode"),
            "OriginatorID",
            "Amount",
            "CurrencyCode",
            F.col("CardholderPresentData").alias("CardholderPresentFlag"),
            terminal_type("CardholderPresentData").alias("TerminalType"),
            "CardType",
            without_commas("MID").alias("MID"),
            F.lit(str(unbranded_brand)).alias("brandid"),
            "currentagebandtext",
            "TranTime",
            F.lit(None).cast("string").alias("UpdateType"),
            day.alias("UpdateDate"),
            day.alias("LoadDate"),
        )
    )
