"""Tasks follow the number of rows, not the bytes of the files."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardloom.operators import merchant, row_runs as rr
from cardloom.operators.incremental import exclude_logged
from tests.conftest import rows


def sparse(spark, n: int, step: int = 7):
    return spark.range(n).select((F.col("id") % 500).alias("FileID"), (F.col("id") * step).alias("RowNum"))


def most_in_a_task(df) -> int:
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_runs_are_made_in_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(rr, "ROWS_PER_TASK", 200, raising=False)
    monkeypatch.setattr(rr, "FEW", 100, raising=False)
    log = rr.row_runs(sparse(spark, 5000))
    assert log.count() == 5000 and most_in_a_task(log) < 400
    after = rr.append_runs(log, sparse(spark, 5000, 11))
    want = sparse(spark, 5000).union(sparse(spark, 5000, 11)).distinct()
    assert rows(rr.expanded(after)) == rows(want)
    assert most_in_a_task(after) < 600


def test_a_log_of_runs_to_exclude_is_made_in_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(rr, "ROWS_PER_TASK", 200, raising=False)
    tx, log = sparse(spark, 3000, 14), sparse(spark, 3000)
    held = rr.row_runs(log)
    assert held.rdd.getNumPartitions() >= 15
    assert rows(exclude_logged(tx, held)) == rows(tx.exceptAll(tx.intersect(log)))


def test_texts_are_dealt_to_rules_by_their_number(spark, monkeypatch, tmp_path):
    texts = [(i, f"shop {i % 97} of {i % 13}") for i in range(600)] + [(1, None), (2, "shop 2 of 2"), (2, "shop 2 of 2"), (None, "shop 9")]
    spark.createDataFrame(texts, "k long, t string").coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    names = ["shop 9%", "%of 1_", "%o%", "%7 of 7", "none", "%\\%%"]
    rules = spark.createDataFrame([(n, n) for n in names] * 2, "rule string, pattern string")
    said = " UNION ALL ".join(f"SELECT k, '{n}' AS rule FROM texts WHERE t LIKE '{n}'" for n in names[:5])
    df.createOrReplaceTempView("texts")
    want = rows(spark.sql(f"SELECT DISTINCT * FROM ({said})"))
    for few in (100, 0):
        monkeypatch.setattr(merchant, "FEW_RULES", few, raising=False)
        monkeypatch.setattr(merchant, "TEXTS_PER_TASK", 50, raising=False)
        found = merchant.match_rules(df, rules, "t", "k")
        assert rows(found) == want
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "13), REPARTITION_BY_NUM" in plan
        assert ("SortMergeJoin" in plan) == (few == 0)
