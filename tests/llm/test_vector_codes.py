from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import pytest

from cardloom.llm import vector_codes


def plain(rows, parts, entries, rounds):
    """The same in plain Python, for rows (vec_id, vector, label) of one dimension."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [[math.floor(4096 * x) for x in r[1]] for r in kept]
    if not kept:
        return [], None
    width = len(whole[0]) // parts
    cut = [[v[j * width : (j + 1) * width] for j in range(parts)] for v in whole]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, whole[i]))[:entries]
    books = [[list(cut[i][j]) for i in first] for j in range(parts)]

    def nearest(j, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[j]))

    for _ in range(rounds):
        for j in range(parts):
            held = defaultdict(list)
            for c in cut:
                held[nearest(j, c[j])[1]].append(c[j])
            for k, members in held.items():
                books[j][k] = [sum(col) // len(members) for col in zip(*members)]
    out = []
    for r, c in zip(kept, cut):
        best = [nearest(j, c[j]) for j in range(parts)]
        out.append((r[0], "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), r[2]))
    total = defaultdict(int)
    for x in out:
        total[x[3]] += x[2]
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return [(*x[:3], total[x[3]], digest) for x in out], digest


def sample(n: int, dims: int, seed: int):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(dims)], rnd.choice([None, 1, 2])) for i in range(n)]
    same = [0.25] * dims
    rows += [(1000 + i, same, 1) for i in range(n // 3)]
    rows += [(5, same, None), (5, same, None), (None, rows[0][1], 2), (7000, None, 1)]
    rows += [(7001, [math.nan] + same[1:], 1), (7002, [None] + same[1:], 1), (7003, [math.inf] + same[1:], 2)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,dims,parts,entries", [(90, 16, 8, 16), (60, 6, 3, 4), (9, 8, 8, 16)])
def test_equals_plain_python(spark, monkeypatch, n, dims, parts, entries):
    monkeypatch.setattr(vector_codes, "ROWS_PER_OWNER", 40)
    monkeypatch.setattr(vector_codes, "ROWS_PER_TASK", 100)
    rows = sample(n, dims, n)
    table = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<double>, label int, code string, entry int")
    found = vector_codes.encode(table, parts, entries)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    expected, _ = plain(rows, parts, entries, vector_codes.ROUNDS)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_only_what_changes_entry_is_shuffled(spark, tmp_path):
    rows = sample(80, 16, 1)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    vectors = vector_codes.integers(table, "vec_id", "embedding", "label", vector_codes.SCALE)
    found = vector_codes.lloyd(vectors, rounds=3)
    moved = found.members.groupBy("moved").count().collect()
    assert sum(r["count"] for r in moved) == 8 * vectors.count()
    # The last assignment reads members where they lie.
    assert "Exchange" not in found.members._jdf.queryExecution().executedPlan().toString()


def test_odd_dimensions(spark):
    rows = [(i, [0.1 * i] * 5, 1) for i in range(20)] + [(50, [1.0] * 4, 1), (51, [], 1), (52, [3.0e38] * 5, 1)]
    found = vector_codes.encode(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    # Other dimensions go; parts that get no component have an error of 0 and the first entry.
    assert sorted(r["vec_id"] for r in found) == [*range(20), 52]
    assert all(len(r["code"]) == 16 and r["error"] >= 0 for r in found)


def test_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vector_codes.encode(spark.createDataFrame([], schema)).count() == 0
    assert vector_codes.encode(spark.createDataFrame([(1, None, 1), (2, [math.nan], 1)], schema)).count() == 0
