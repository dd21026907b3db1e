"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from workload import ORACLES, QUERIES
from workload.roles import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("NestedLoop", "Cartesian", "Python", "Pandas"))
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = Counter(result.fetchall())
    assert Counter(tuple(r) for r in df.select(*columns).collect()) == expected


def test_the_debit_feed_makes_its_transactions_once(spark):
    feed = QUERIES["dd_feed_h15"](spark, SF)
    read = feed.inputFiles()
    assert any("/dd-tx/" in f for f in read) and not any("lineitem" in f for f in read)
