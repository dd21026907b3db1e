"""Passes are planned from all vectors of a group."""

from __future__ import annotations

import numpy as np
import pytest

from cardloom.llm import embedding_dedup
from cardloom.llm.shipping import ship


def test_every_vector_is_in_the_plan(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(embedding_dedup, "SAMPLE", 0, raising=False)  # no sample is drawn
    rng = np.random.default_rng(3)
    rows = [(i, "a" if i % 3 else "b", rng.normal(size=16).tolist()) for i in range(900)] + [(900 + i, "c", [1.0, float(i)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, group string, vec array<double>")
    plans = {r["group"]: r for r in embedding_dedup.planned(df, 0.93, 64, 0.999).collect()}
    again = {r["group"]: r for r in embedding_dedup.planned(df.repartition(7), 0.93, 64, 0.999).collect()}
    assert plans == again and plans["c"]["passes"] == 1
    for g in "ab":
        x = embedding_dedup.units([v for _, h, v in rows if h == g])
        assert plans[g]["passes"] > 1 and np.allclose(plans[g]["centre"], x.mean(0), atol=1e-8)


@pytest.mark.parametrize("reach", [0, 1, 5])
def test_depths_tell_what_lies_beyond_reach(reach):
    rng = np.random.default_rng(reach)
    code = np.sort(rng.integers(0, 1 << 40, 200) >> 34 << 34)
    signs = rng.integers(0, 1 << 63, (200, 2)).astype(np.uint64)
    deep = embedding_dedup.depths(code, signs, np.full(200, -1.0), reach)
    text = [f"{c:040b}" for c in code]
    for i in range(200):
        if deep[i] < 40:
            alike = [j for j in range(200) if text[j][: deep[i]] == text[i][: deep[i]]]
            assert all(abs(j - i) <= reach for j in alike)
