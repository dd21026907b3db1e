"""The row log as runs against the plain log."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cardloom.operators import row_runs as rr
from cardloom.operators.incremental import append_row_log, exclude_logged
from tests.conftest import rows

KEY = "FileID int, RowNum int"


def islands(keys) -> list[tuple]:
    out = []
    for f, n in sorted({k for k in keys if None not in k}):
        if out and out[-1][0] == f and out[-1][2] == n - 1:
            out[-1] = (f, out[-1][1], n)
        else:
            out.append((f, n, n))
    return out


def some_keys(seed: int, n: int) -> list[tuple]:
    rnd = random.Random(seed)
    keys = [(rnd.randrange(3), rnd.randrange(-40, 120)) for _ in range(n)]
    return keys + keys[:5] + [(None, 3), (1, None), (2, 5000), (2, -5000)]


@pytest.mark.parametrize("block", [1, 8, 1 << 20])
def test_runs_are_maximal(spark, block):
    keys = some_keys(block, 150)
    parts = [rr.as_runs(spark.createDataFrame(keys[i::2], KEY)) for i in range(2)]
    assert rows(rr.merge_runs(*parts, block=block)) == sorted(islands(keys), key=repr)


@pytest.mark.parametrize("block", [1, 8, 4096])
def test_overlapping_runs_and_gaps(spark, block):
    runs = [(1, 1, 10), (1, 5, 7), (1, 11, 12), (1, 14, 20), (1, 20, 33), (2, 0, 0), (2, 2, 2), (3, 9, 3)]
    log = spark.createDataFrame(runs, "FileID int, FirstRow long, LastRow long")
    assert rows(rr.merge_runs(log, block=block)) == [(1, 1, 12), (1, 14, 33), (2, 0, 0), (2, 2, 2)]
    tx = spark.createDataFrame([(f, n) for f in (1, 2, 3, None) for n in (*range(-1, 36), None)], KEY)
    covered = {(f, n) for f, a, b in runs for n in range(a, b + 1)}
    kept = [k for k in map(tuple, tx.collect()) if k not in covered]
    assert rows(rr.exclude_runs(tx, log, block=block)) == sorted(kept, key=repr)


def test_exclusion_equals_the_plain_log(spark):
    tx = spark.createDataFrame([(*k, i) for i, k in enumerate(some_keys(1, 200))], KEY + ", Amount int")
    logs = [spark.createDataFrame(some_keys(s, 60), KEY) for s in (2, 3)]
    plain = rows(exclude_logged(tx, *logs))
    as_runs = [rr.row_runs(log) for log in logs]
    assert rows(exclude_logged(tx, *as_runs)) == plain
    assert rows(exclude_logged(tx, logs[0], as_runs[1])) == plain
    assert rows(exclude_logged(tx, *as_runs, prune_by="FileID")) == rows(exclude_logged(tx, *logs, prune_by="FileID"))


def test_append_equals_the_plain_log(spark):
    log, first, second = (spark.createDataFrame(some_keys(s, 50), KEY) for s in (4, 5, 6))
    after = rr.append_runs(rr.row_runs(log), first, second)
    assert rows(after) == sorted(islands(map(tuple, append_row_log(log, first, second).collect())), key=repr)
    back = rr.expanded(after)
    assert back.count() == back.distinct().count() == sum(b - a + 1 for _, a, b in islands(map(tuple, append_row_log(log, first, second).collect())))


def test_a_million_rows_of_a_file_are_one_run(spark):
    keys = spark.range(2_000_000).select((F.col("id") % 2).cast("int").alias("FileID"), F.expr("cast(id div 2 as int)").alias("RowNum"))
    log = rr.row_runs(keys)
    assert rows(log) == [(0, 0, 999_999), (1, 0, 999_999)]
    assert exclude_logged(keys, log).count() == 0
    assert exclude_logged(keys.withColumn("RowNum", F.col("RowNum") + 10), log).count() == 20


def test_rows_are_not_shuffled_for_a_small_log(spark, tmp_path):
    spark.range(50_000).select(F.lit(1).alias("FileID"), F.col("id").cast("int").alias("RowNum")).write.parquet(f"{tmp_path}/tx")
    spark.createDataFrame([(1, 0, 40_000)], "FileID int, FirstRow long, LastRow long").write.parquet(f"{tmp_path}/log")
    kept = exclude_logged(spark.read.parquet(f"{tmp_path}/tx"), spark.read.parquet(f"{tmp_path}/log"))
    assert kept.count() == 9_999
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
