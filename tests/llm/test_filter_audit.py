from __future__ import annotations

import random
import time
from collections import Counter
from itertools import permutations

import pandas as pd
import pytest

from cardloom.llm import filter_audit as audit

WORDS = [f"word{i}" for i in range(300)]


def fails(row, rows) -> set[str]:
    """The filters that a row (id, text, part) fails, in plain Python."""
    text = row[1] or ""
    words = text.split()
    out = {"A"} if len(words) < 200 else set()
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text):
        out.add("C")
    if any(c in "#$%&*|" for c in text):
        out.add("D")
    if any(r[0] is not None and row[0] is not None and r[0] < row[0] and (r[1] or "") == text for r in rows):
        out.add("E")
    return out


def expected(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    out = set()
    failed = [(r, fails(r, rows)) for r in rows]
    for part in {r[2] or "" for r in rows}:
        mine = [(r, f) for r, f in failed if (r[2] or "") == part]
        table = {}
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(r, f) for r, f in left if x in f]
                left = [(r, f) for r, f in left if x not in f]
                table["".join(order), step] = (
                    x,
                    len(left),
                    len(gone),
                    sum(x in f for _, f in mine) - len(gone),
                    sum(f == {x} for _, f in mine),
                    sum(r[0] in good for r, _ in gone),
                    sum(r[0] in toxic for r, _ in gone),
                )
        by_filter = Counter()
        for v in table.values():
            by_filter[v[0]] += v[2]
        out |= {(part, *k, *v[1:], by_filter[v[0]]) for k, v in table.items()}
    return out


def sample(n: int, seed: int):
    rnd = random.Random(seed)
    texts = [None, "", "Shout OUT #1", " ".join(WORDS), " ".join(WORDS[:50] * 5), "$ " + " ".join(WORDS[:250]), "é" * 9]
    rows = [(rnd.choice([None, *range(30)]), rnd.choice(texts), rnd.choice(["en", "de", "", None])) for _ in range(n)]
    rows += rows[:5]
    labels = [(rnd.choice([None, *range(40)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(25)]
    return rows, [x for x in labels if x[0] is not None]


@pytest.mark.parametrize("files", [1, 4])
def test_audit_equals_plain_python(spark, tmp_path, files):
    rows, labels = sample(120, files)
    path = str(tmp_path / "docs.parquet")
    # Large ids come first, so that smaller ones retract what was counted.
    rows.sort(key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    for i in range(files):
        part = spark.createDataFrame(rows[i * len(rows) // files : (i + 1) * len(rows) // files], "doc_id long, text string, lang string")
        part.withColumns({"key": part["lang"], "state": part["doc_id"]}).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit.audit(spark, path, marks)
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r) for r in found.collect()} == expected(rows, labels)


def test_stream_goes_on_with_new_files_and_retracts(spark, tmp_path):
    path, folder = str(tmp_path / "docs"), str(tmp_path / "state")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    write = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, text string, lang string").coalesce(1).write.mode("append").parquet(path)
    masks = lambda: {
        (r["part"], r["flags"]): r["n"] for r in audit.count_masks(spark, audit.source(spark, path), labels, folder=folder).collect()
    }
    copy = audit.BIT_COPY
    write((7, "same", "en"), (9, "same", "de"))
    assert masks() == {("en", 1): 1, ("de", 1 | copy): 1}
    write((1, "same", "fr"), (1, "same", "fr"))
    assert masks() == {("en", 1 | copy): 1, ("de", 1 | copy): 1, ("fr", 1 | audit.GOOD): 2}
    assert masks() == {("en", 1 | copy): 1, ("de", 1 | copy): 1, ("fr", 1 | audit.GOOD): 2}


def test_settle_in_any_order():
    rnd = random.Random(5)
    rows = [(rnd.randrange(4), rnd.choice([None, *range(6)]), rnd.choice("xy"), rnd.choice([0, 1])) for _ in range(60)]
    held, total = None, Counter()
    run = audit.combined(3)
    for i in range(0, 60, 7):
        done = rows[: i + 7]
        batch = pd.DataFrame([(f"{k:032x}", i, p, f) for k, i, p, f in rows[i : i + 7]], columns=["key", "id", "part", "flags"])
        (new,) = run(iter([batch.astype({"id": "Int64"})]))
        held, change = audit.settle(held, new.drop(columns="state"))
        held = audit.unpacked(audit.packed(held))
        for part, flags, n in change.itertuples(index=False):
            total[part, flags] += n
        low = {k: min((x[1] for x in done if x[0] == k and x[1] is not None), default=None) for k in range(4)}
        plain = Counter((p, f | (audit.BIT_COPY if i is not None and i > low[k] else 0)) for k, i, p, f in done)
        assert +total == plain and not -total


def test_hot_text_sends_few_rows():
    batch = pd.DataFrame({"key": ["ab" * 32] * 5000, "id": range(5000), "part": ["en"] * 5000, "flags": [3] * 5000}).astype({"id": "Int64"})
    (out,) = audit.combined(7)(iter([batch]))
    assert len(out) == 2 and out["n"].sum() == 5000


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(path)
    assert audit.audit(spark, path, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
