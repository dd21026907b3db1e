"""Join helpers against plain joins and windows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardloom.functions.joins import anti, binned, hot_keys, neighbour, not_in, salted_join, with_group_values
from cardloom.operators.card import subscription_flag
from tests.conftest import rows


@pytest.mark.parametrize(
    "listed, kept",
    [
        ([("a",)], [("b",)]),
        ([("a",), (None,)], []),
        ([], [("a",), ("b",), (None,)]),
    ],
)
def test_not_in_follows_sql(frame, listed, kept):
    df = frame("k string", ("a",), ("b",), (None,))
    assert rows(not_in(df, "k", frame("x string", *listed), "x")) == sorted(kept, key=repr)


def test_anti_keeps_null_keys(frame):
    df = frame("k string", ("a",), ("b",), (None,))
    assert rows(anti(df, frame("k string", ("a",), (None,)), ["k"])) == sorted([("b",), (None,)], key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, frame, how):
    rng = random.Random(5)
    left = [(rng.choice([1, 1, 1, 1, 2, 3, 4, None]), i) for i in range(400)]
    df = frame("k int, i int", *left)
    right = frame("k int, v string", (1, "a"), (1, "b"), (2, "c"), (5, "d"))
    hot = hot_keys(df, ["k"], rows_per_split=30)
    assert {r["k"]: r["_splits"] for r in hot.collect()}[1] >= 5
    plain = df.join(right, "k", how).select(*(["k", "i"] if "left_" in how else ["k", "i", "v"]))
    assert rows(salted_join(df, right, ["k"], how, ["i"], hot)) == rows(plain)


def test_hot_list_over_some_of_the_keys(frame):
    df = frame("a int, b int, i int", *[(1, i % 2, i) for i in range(50)], (2, 0, 99))
    right = frame("a int, b int, v string", (1, 0, "x"), (1, 1, "y"), (2, 0, "z"))
    got = salted_join(df, right, ["a", "b"], "inner", ["i"], hot_keys(df, ["a"], rows_per_split=10))
    assert rows(got) == rows(df.join(right, ["a", "b"]).select("a", "b", "i", "v"))


def test_the_hot_list_is_bounded(spark, monkeypatch):
    monkeypatch.setattr("cardloom.functions.joins.MOST_HOT_KEYS", 5)
    df = spark.range(1000).selectExpr("if(id < 300, 0, id div 10) k")
    assert [r["k"] for r in hot_keys(df, ["k"], rows_per_split=2).collect()] == [0]


def test_group_values_equal_a_window(frame):
    rng = random.Random(6)
    df = frame("g int, i int", *[(rng.choice([1, 1, 2, 3]), i) for i in range(200)])
    plain = df.withColumn("m", F.max("i").over(Window.partitionBy("g")))
    assert rows(with_group_values(df, ["g"], ["i"], m=F.max("i"))) == rows(plain)


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("unit", ["hour", "day", "week", "year"])
def test_neighbour_equals_a_window(frame, following, unit):
    """One key holds most rows, values and order columns contain NULL."""
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(500):
        at = None if rng.random() < 0.05 else start + timedelta(hours=rng.randrange(0, 24 * 60))
        data.append((rng.choice(["hot"] * 6 + ["a", "b", "c"]), at, i, rng.choice([None, *range(9)])))
    df = frame("k string, at timestamp_ntz, i int, v int", *data)
    near = F.lead if following else F.lag
    plain = df.withColumn("n", near("v").over(Window.partitionBy("k").orderBy("at", "i")))
    got = neighbour(df, "v", "k", ["at", "i"], F.date_trunc(unit, "at"), "n", following=following)
    assert rows(got) == rows(plain)


@pytest.mark.parametrize("unit", ["day", "week", "month", "year"])
def test_periods_in_bins_equal_the_plain_join(spark, unit):
    rnd = random.Random(unit)
    day = lambda: date(2023, 1, 1) + timedelta(days=rnd.randrange(700))
    tx = [(i, rnd.choice([1, 2, None]), 5, rnd.choice([None, day(), day()])) for i in range(120)]
    periods = [(rnd.choice([1, 2, None]), 5, day(), rnd.choice([None, day(), day()])) for _ in range(60)]
    t = spark.createDataFrame(tx, "id int, BrandID int, Amount int, TranDate date")
    p = spark.createDataFrame(periods, "BrandID int, Amount int, startdate date, enddate date")
    assert rows(subscription_flag(t, p, period_bin=unit)) == rows(subscription_flag(t, p))
    assert subscription_flag(t.limit(0), p, period_bin=unit).count() == 0


def test_many_periods_of_a_price_are_spread_over_bins(spark):
    # 10,000 periods of one price over 27 years: no bin has more than the 31 that touch a month.
    p = spark.range(10_000).select(F.lit(1).alias("BrandID"), F.lit(5).alias("Amount"), F.expr("date_add(date'1996-01-01', cast(id as int))").alias("startdate"))
    p = p.withColumn("enddate", F.date_add("startdate", 1))
    t = p.select(F.monotonically_increasing_id().alias("id"), "BrandID", "Amount", F.col("startdate").alias("TranDate"))
    bins = binned(p, "startdate", "enddate", t, "TranDate", "month", "bin")
    assert bins.count() == 10_000 and bins.groupBy("bin").count().agg(F.max("count")).first()[0] == 31
    found = subscription_flag(t, p, period_bin="month")
    assert found.count() == 10_000 and found.where("subscription_flag = 0").count() == 0
