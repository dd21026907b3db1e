"""Incremental loading and card feed operators on edge rows."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardloom.operators import card, incremental as inc
from tests.conftest import rows

AS_OF = datetime(2024, 3, 31, 4, 0, 0)
TX = (
    "FileID int, RowNum int, ConsumerCombinationID int, CardholderPresentData int, TranDate date, CINID int,"
    " Amount decimal(18,2), IsOnline int, InputModeID int"
)


def tx(file, row, merchant=1, day=date(2024, 3, 1), cin=1, amount="9.99"):
    return (file, row, merchant, 0, day, cin, Decimal(amount), 0, 3)


def test_append_is_idempotent(frame):
    source = frame("FileID int, RowNum int, x string", (1, 1, "a"), (1, 2, "b"), (None, 3, "n"))
    target = frame("FileID int, RowNum int", (1, 1))
    first = inc.incremental_append(source, target, consts={"PaymentTypeID": 1})
    assert rows(first) == sorted([(1, 2, "b", 1), (None, 3, "n", 1)], key=repr)
    again = inc.incremental_append(source, inc.append_row_log(target, first))
    assert rows(again) == [(None, 3, "n")]


def test_pruned_log_gives_the_same_rows(frame):
    df = frame("FileID int, RowNum int", *[(f, r) for f in (50, 51, None) for r in range(4)])
    log = frame("FileID int, RowNum int", *[(f, 2) for f in range(100)], (51, None))
    assert rows(inc.exclude_logged(df, log, prune_by="FileID")) == rows(inc.exclude_logged(df, log))
    assert inc.exclude_logged(df.where("false"), log, prune_by="FileID").count() == 0


def test_load_dates(frame):
    log = frame("LoadDate date", (date(2024, 3, 31),), (date(2024, 3, 2),))
    grown = inc.append_load_date(log, AS_OF)
    assert rows(grown)[0] == (date(2024, 3, 2),) and grown.count() == 3
    assert (date(2024, 3, 30),) in rows(grown)
    assert rows(inc.last_load_date(log, AS_OF)) == [(date(2024, 3, 2),)]


def test_newly_eligible(frame):
    customers = frame(
        "cinid int, inprogram int, RegistrationDate date",
        (1, 1, date(2020, 1, 1)),
        (2, 1, date(2020, 1, 1)),
        (3, 0, date(2020, 1, 1)),
        (4, 1, date(2024, 3, 1)),
        (5, 0, date(2024, 2, 29)),
        (1, 1, date(2020, 1, 1)),
    )
    archive = frame("cinid int", (2,), (2,), (4,))
    assert rows(inc.newly_eligible(customers, archive, AS_OF)) == [(1,), (4,)]


def test_history_starts_after_the_first_of_the_month(frame):
    debit = frame(TX, tx(1, 1, day=date(2019, 3, 1)), tx(1, 2, day=date(2019, 3, 2)), tx(1, 3, cin=2), tx(1, 4))
    credit = frame(TX, tx(2, 1)).drop("InputModeID")
    got = inc.backfill_history(debit, credit, frame("cinid int", (1,)), [frame("FileID int, RowNum int", (1, 4))], AS_OF)
    kept = {(r["FileID"], r["RowNum"], r["PaymentTypeID"], r["InputModeID"]) for r in got.collect()}
    assert kept == {(1, 2, 1, 3), (2, 1, 2, None)}


def test_purge(frame):
    table = frame("a int", (1,))
    assert inc.purge_on_weekday(table, datetime(2024, 3, 30)).count() == 0
    assert inc.purge_on_weekday(table, datetime(2024, 3, 29)).count() == 1
    assert inc.purge(table).schema == table.schema


@pytest.mark.parametrize(
    "day, amount, brand, flags",
    [
        (date(2024, 1, 1), "9.99", 7, [1]),
        (date(2023, 12, 31), "9.99", 7, [0]),
        (date(2024, 1, 31), "9.99", 7, [1]),
        (date(2024, 2, 1), "9.99", 7, [0]),
        (date(2024, 1, 15), "9.98", 7, [0]),
        (date(2024, 1, 15), "9.99", 8, [0]),
        (date(2099, 12, 31), "5.00", 7, [1]),
        (date(2100, 1, 1), "5.00", 7, [0]),
        (date(2024, 5, 5), "3.00", 7, [1, 1]),
    ],
)
def test_subscription_periods(frame, day, amount, brand, flags):
    periods = frame(
        "BrandID int, Amount decimal(18,2), startdate date, enddate date",
        (7, Decimal("9.99"), date(2024, 1, 1), date(2024, 2, 1)),
        (7, Decimal("5.00"), date(2024, 1, 1), None),
        (7, Decimal("3.00"), date(2024, 1, 1), None),
        (7, Decimal("3.00"), date(2024, 5, 1), date(2024, 6, 1)),
    )
    one = frame("BrandID int, Amount decimal(18,2), TranDate date", (brand, Decimal(amount), day))
    assert [r["subscription_flag"] for r in card.subscription_flag(one, periods).collect()] == flags


@pytest.fixture
def dims(frame):
    return dict(
        customers=frame("cinid int, inprogram int, insight_ageband string", (1, 1, "A"), (2, 0, "B")),
        merchants=frame("ConsumerCombinationID int, BrandID int, MID string, MCCID int", (1, 7, "1,2", 5), (2, 8, "3", 6)),
        periods=frame("BrandID int, Amount decimal(18,2), startdate date, enddate date"),
        mcc=frame("MCCID int, MCC string", (5, "5411")),
    )


def timed(df):
    return df.withColumns({"PaymentTypeID": F.lit(1), "TranTime": F.lit("09:00:00")})


def test_enrichment_drops_unknown_partners_and_keeps_unknown_category(frame, dims):
    df = timed(frame(TX, tx(1, 1), tx(1, 2, merchant=2), tx(1, 3, merchant=99), tx(1, 4, cin=99), tx(1, 5, cin=2)))
    got = card.enrich_card(df, **dims)
    assert {(r["RowNum"], r["mcc"], r["TranSequenceID"]) for r in got.collect()} == {
        (1, "5411", "1-1-1"),
        (2, None, "1-1-2"),
    }
    assert rows(card.enrich_card(df, **dims, rows_per_split=1)) == rows(got)


def test_programme_flag_of_backfilled_rows_only(frame, dims):
    df = timed(frame(TX, tx(1, 1, cin=2), tx(1, 2, cin=2)))
    df = df.withColumn("IsBackfill", F.col("RowNum") == 2)
    got = card.enrich_card(df, **dims, in_program_for="backfill")
    assert [r["RowNum"] for r in got.collect()] == [1]


def test_feed_shapes(frame, dims):
    enriched = card.enrich_card(timed(frame(TX, tx(1, 1))), **dims)
    plain = card.card_feed(enriched, AS_OF).first()
    assert plain["mid"] == "12" and plain["LoadDate"] == date(2024, 3, 30) and plain["UpdateType"] == "N"
    detailed = card.card_feed(enriched, AS_OF, detailed=True).first()
    assert detailed["mid"] == "1,2" and detailed["FileID"] == 1 and detailed["InputModeID"] == 3


def test_new_rows_are_not_repeated_from_the_backfill(frame):
    staged = frame(TX, tx(1, 1), tx(1, 2), tx(1, 3))
    backfill = frame("FileID int, RowNum int", (1, 2))
    log = frame("FileID int, RowNum int", (1, 3))
    times = frame("FileID int, RowNum int, TranTime string", (1, 1, "10:45:10"))
    got = card.select_new(staged, staged.where("false"), times, [log], backfill)
    assert [(r["RowNum"], r["TranTime"]) for r in got.collect()] == [(1, "10:30:00")]
