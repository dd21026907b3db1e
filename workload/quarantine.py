"""Queries over the quarantine feed."""

from __future__ import annotations

from cardloom.functions.keys import terminal_type
from cardloom.operators import quarantine as q
from workload.card import ROUNDED
from workload.customers import AGE_INSIGHT
from workload.registry import query
from workload.roles import AS_OF, Roles

UNBRANDED = 9
UNLOGGED = "NOT EXISTS (SELECT 1 FROM {quarantine_log} l WHERE l.FileID = h.FileID AND l.RowNum = h.RowNum)"
DEBIT = "SELECT * FROM {pending_debit} h WHERE CINID IN (SELECT CINID FROM {affinity_customers}) AND " + UNLOGGED
CREDIT = (
    """SELECT FileID, RowNum, h.CINID, TranDate, MID, MCCID, Narrative, LocationCountry, OriginatorReference AS OriginatorID, Amount,
              CardholderPresentMc AS CardholderPresentData, PaymentTypeID, LocationID
       FROM {pending_credit} h JOIN {affinity_customers} c ON c.CINID = h.CINID AND c.rw = 1 WHERE """
    + UNLOGGED
)
NORMAL = f"""
    SELECT h.FileID, h.RowNum, CAST(NULL AS INTEGER) AS ConsumerCombinationID, CardholderPresentData, TranDate, Amount, c.FanID,
           h.CINID, 'GBP' AS CurrencyCode, CardholderPresentData AS CardholderPresentFlag,
           CASE PaymentTypeID WHEN 1 THEN 'D' WHEN 2 THEN 'C' ELSE 'U' END AS CardType, c.PostalArea AS CardholderPostalArea,
           c.SourceUID, c.PostcodeDistrict AS CardholderPostcodeDistrict,
           concat('1-', CAST(h.FileID AS VARCHAR), '-', CAST(h.RowNum AS VARCHAR)) AS TransSequenceID, OriginatorID, LocationCountry,
           Narrative, h.MCCID, LocationID, replace(MID, ',', '') AS MID, m.MCC,
           {ROUNDED.replace("TranTime", "t.TransactionTime")} AS TranTime
    FROM ({DEBIT} UNION ALL {CREDIT}) h JOIN {{affinity_customers}} c ON c.CINID = h.CINID AND c.rw = 1
    JOIN {{mcc}} m ON m.MCCID = h.MCCID LEFT JOIN {{inbound_times}} t ON t.FileID = h.FileID AND t.RowNum = h.RowNum"""
# Terminal types by code.
TERMINAL = """CASE WHEN {0} = 0 THEN 'P' WHEN {0} = 1 THEN 'U' WHEN {0} = 2 THEN 'C' WHEN {0} = 3 THEN 'C' WHEN {0} = 4 THEN 'R'
    WHEN {0} = 5 THEN 'E' WHEN {0} = 9 THEN 'N' ELSE 'Unknown' END"""


def debit(r: Roles):
    return q.hold_debit(r.pending_debit, r.affinity_customers, r.quarantine_log, "FileID")


def credit(r: Roles):
    return q.hold_credit(r.pending_credit, r.affinity_customers, r.quarantine_log, "FileID")


def normal(r: Roles):
    return q.normalise_quarantine(debit(r), credit(r), r.affinity_customers, r.mcc, r.inbound_times)


@query("hold_debit_e1", DEBIT)
def _(r: Roles):
    return debit(r)


@query("hold_credit_e2", CREDIT)
def _(r: Roles):
    return credit(r)


@query("normalise_quarantine_e3", NORMAL)
def _(r: Roles):
    return normal(r)


@query(
    "terminal_type_e4",
    "SELECT FileID, RowNum, CardholderPresentData, "
    + TERMINAL.format("CardholderPresentData")
    + " AS TerminalType FROM {card_tx}",
)
def _(r: Roles):
    return r.card_tx.select(
        "FileID", "RowNum", "CardholderPresentData", terminal_type("CardholderPresentData").alias("TerminalType")
    )


@query(
    "quarantine_feed_e5",
    "WITH held AS ("
    + NORMAL
    + f""") SELECT TransSequenceID, h.CINID, TranDate, m.MCC, replace(Narrative, ',', '') AS MerchantNarrative,
            LocationCountry AS CountryCode, l.LocationAddress AS MerchantLocation, z.merchantzip AS MerchantPostcode, OriginatorID,
            Amount, CurrencyCode, CardholderPresentData AS CardholderPresentFlag,
            {TERMINAL.format("CardholderPresentData")} AS TerminalType, CardType, MID, '9' AS brandid,
            {AGE_INSIGHT.format("p.AgeCurrent")} AS currentagebandtext, TranTime, CAST(NULL AS VARCHAR) AS UpdateType,
            DATE '2001-08-01' AS UpdateDate, DATE '2001-08-01' AS LoadDate
        FROM held h JOIN {{id_map}} i ON i.CINID = h.CINID JOIN {{people}} p ON p.SourceUID = i.CIN
        JOIN {{mcc}} m ON m.MCCID = h.MCCID LEFT JOIN {{locations}} l ON l.LocationID = h.LocationID
        LEFT JOIN {{merchant_zips}} z ON z.merchantid = h.MID
        WHERE p.CurrentlyActive AND NOT EXISTS (SELECT 1 FROM {{duplicate_cins}} d WHERE d.CIN = p.SourceUID AND d.FanID = p.FanID)""",
)
def _(r: Roles):
    return q.quarantine_feed(
        normal(r),
        r.id_map,
        r.people,
        r.locations,
        r.merchant_zips,
        r.duplicate_cins,
        UNBRANDED,
        AS_OF,
    )
