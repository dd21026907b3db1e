"""The n-gram join and the vector passes against brute force."""

from __future__ import annotations

import random
import re
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from cardloom.llm import embedding_dedup, ngram_join
from cardloom.llm.queries import QUERIES
from cardloom.llm.shared import local_components
from cardloom.llm.shipping import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def brute(docs, likeness, words):
    """(key, n, component, links) of every row with a key, by comparing all pairs."""
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    pairs = []
    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and docs[a][0] is not None and docs[b][0] is not None and both >= likeness * (len(sets[a]) + len(sets[b]) - both):
                pairs.append((a, b))
    near = {i: {i} for i in range(len(docs))}
    for a, b in pairs:
        whole = near[a] | near[b]
        for i in whole:
            near[i] = whole
    links = [sum(i in p for p in pairs) for i in range(len(docs))]
    low = lambda i: None if docs[i][0] is None else min(docs[j][0] for j in near[i])
    return sorted(((docs[i][0], len(sets[i]), low(i), links[i]) for i in range(len(docs))), key=repr)


def joined(spark, docs, **kw):
    rows = spark.createDataFrame([(*d, "c", 1) for d in docs], "doc_id long, text string, class string, n long")
    return sorted((tuple(r) for r in ngram_join.join(rows, **kw).collect()), key=repr)


def variants(rng, copies, edits):
    base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 160))]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(400)}"
        yield " ".join(w[: len(w) - rng.randrange(3)] or ["w"])


@pytest.mark.parametrize("seed, likeness, words", [(1, Fraction(85, 100), 4), (2, Fraction(4, 5), 5), (3, Fraction(1, 2), 2)])
def test_join_equals_all_pairs(spark, seed, likeness, words, monkeypatch):
    rng = random.Random(seed)
    texts = [t for _ in range(12) for t in variants(rng, 9, 6)]
    shared = " ".join(f"p{i}" for i in range(60))
    texts += [shared + " " + t for t in texts[:20]] + ["the same", "The  SAME", "the\tsame", None, "", " \n", "one", "a b c"]
    docs = [*enumerate(texts), (0, texts[0]), (0, "another text under a known key"), (None, texts[1]), (None, None)]
    rng.shuffle(docs)
    monkeypatch.setattr(ngram_join, "TASK_SHINGLES", 600)  # so that groups are cut into chunks
    assert joined(spark, docs, likeness=likeness, words=words) == brute(docs, likeness, words)


def test_join_of_nothing_and_of_long_texts(spark):
    assert joined(spark, []) == []
    long = " ".join(f"x{i}" for i in range(40_000))
    docs = [(1, long), (2, long + " y"), (3, None), (4, "x0 x1 x2 x3")]
    assert joined(spark, docs) == brute(docs, Fraction(85, 100), 4)


def test_divide_skip_equals_all_pairs():
    rng = np.random.default_rng(4)
    for t in (Fraction(1, 2), Fraction(85, 100)):
        base = [np.unique(rng.integers(0, 300, 80)) for _ in range(6)]
        sets = [np.unique(np.concatenate([b[rng.random(len(b)) > 0.1 * rng.random()], rng.integers(300, 999, 4)])) for b in base for _ in range(8)]
        every = np.arange(len(sets))
        want = {(i, j) for i in every for j in every if i < j and len(np.intersect1d(sets[i], sets[j])) >= t * len(np.union1d(sets[i], sets[j]))}
        i, j = ngram_join.divide_skip(sets, every, every, t, True)
        assert {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())} == want and len(i) == len(want)
        i, j = ngram_join.divide_skip(sets, every[:20], every[20:], t, False)
        assert set(zip(i.tolist(), j.tolist())) == {p for p in want if p[0] < 20 <= p[1]}


def test_the_lower_bound_of_shared_counted_shingles_holds():
    rng = np.random.default_rng(7)
    for t in (Fraction(85, 100), Fraction(4, 5)):
        for _ in range(400):
            n = int(rng.integers(1, 300))
            common = rng.choice(10**6, n, False)
            a = np.unique(np.concatenate([common, rng.integers(10**6, 2 * 10**6, int(rng.integers(0, n // 5 + 1)))]))
            b = np.unique(np.concatenate([common, rng.integers(2 * 10**6, 3 * 10**6, int(rng.integers(0, n // 5 + 1)))]))
            if n >= t * (len(a) + len(b) - n):
                order = lambda s: np.sort(ngram_join.spread_bits(s.astype(np.uint64)))
                low_a, low_b = order(a)[: ngram_join.counted(len(a))], order(b)[: ngram_join.counted(len(b))]
                both = len(np.intersect1d(low_a, low_b))
                assert both >= ngram_join.least_shared(len(a), t) and both >= ngram_join.least_shared(len(b), t)


def test_local_components():
    i, j = np.array([1, 2, 5, 8]), np.array([2, 3, 9, 5])
    assert local_components(10, i, j).tolist() == [0, 1, 1, 1, 4, 5, 6, 7, 5, 5]
    assert local_components(3, i[:0], j[:0]).tolist() == [0, 1, 2]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, class string, id string")


def all_pairs(rows, cosine):
    ok = [r[1] is not None and r[2] is not None and r[0] is not None and len(r[1]) > 0 and None not in r[1] and bool(np.isfinite(r[1]).all()) and any(r[1]) for r in rows]
    units = [np.array(r[1], np.float32).astype(float) / np.linalg.norm(np.array(r[1], np.float32).astype(float)) if k else None for r, k in zip(rows, ok)]
    near = {i: {i} for i in range(len(rows))}
    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]) and units[a] @ units[b] >= cosine:
                links[a] += 1
                links[b] += 1
                whole = near[a] | near[b]
                for i in whole:
                    near[i] = whole
    low = lambda i: None if rows[i][0] is None else min(rows[j][0] for j in near[i])
    return sorted(((rows[i][0], links[i], low(i), rows[i][0] == low(i)) for i in range(len(rows))), key=repr)


def test_vectors_equal_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(30):
        center = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((len(rows), (center + rng.normal(size=16) * 0.12).tolist(), g % 3))
    same = rng.normal(size=16).tolist()
    rows += [(len(rows) + k, same, 1) for k in range(40)]
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [1.0, None] + [0.0] * 14, 1), (904, [float("nan")] * 16, 1)]
    rows += [(905, [float("inf")] + [0.0] * 15, 1), (906, same, None), (None, same, 1), (907, same[:8], 1), (908, [2 * x for x in same], 1), rows[0], (0, same, 1), (0, rows[9][1], rows[9][2])]
    monkeypatch.setattr(embedding_dedup, "ROWS_PER_TASK", 7)
    got = sorted((tuple(r) for r in embedding_dedup.dedup(vectors(spark, rows)).collect()), key=repr)
    assert got == all_pairs(rows, 0.93)
    assert embedding_dedup.dedup(vectors(spark, rows).limit(0)).count() == 0


def test_passes_find_most_borderline_pairs(spark):
    rng = np.random.default_rng(9)
    rows = []
    for k in range(3000):
        a = rng.normal(size=32)
        a /= np.linalg.norm(a)
        rows.append((2 * k, a.tolist(), 0))
        d = rng.normal(size=32)
        d -= (d @ a) * a
        c = rng.uniform(0.935, 0.97)
        rows.append((2 * k + 1, (c * a + np.sqrt(1 - c * c) * d / np.linalg.norm(d)).tolist(), 0))
    out = embedding_dedup.dedup(vectors(spark, rows))
    assert out.where("n_links > 0").count() / 6000 >= 0.95


def planted_pairs(spark, pairs, mean, cosine=0.935, dims=32):
    """Pairs at a cosine in one label; unrelated vectors have the cosine ``mean``."""

    def make(batches):
        for batch in batches:
            rng, n = np.random.default_rng([9, int(batch["id"].iat[0])]), len(batch)
            a, d = rng.normal(size=(n, dims - 1)), rng.normal(size=(n, dims - 1))
            a /= np.linalg.norm(a, axis=1)[:, None]
            d -= (d * a).sum(1)[:, None] * a
            d /= np.linalg.norm(d, axis=1)[:, None]
            c = (cosine - mean) / (1 - mean)
            both = np.stack([a, c * a + np.sqrt(1 - c * c) * d], 1).reshape(2 * n, dims - 1) * np.sqrt(1 - mean)
            both = np.hstack([both, np.full((2 * n, 1), np.sqrt(mean))])
            ids = (2 * batch["id"].to_numpy()[:, None] + [0, 1]).ravel()
            yield pd.DataFrame({"vec_id": ids, "embedding": list(both.astype(np.float32)), "label": 0})

    return spark.range(0, pairs, 1, 8).mapInPandas(make, "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("mean", [0.0, 0.5, 0.7])
def test_recall_in_one_large_label(spark, monkeypatch, mean):
    plans, made = [], embedding_dedup.planned
    monkeypatch.setattr(embedding_dedup, "planned", lambda *a: plans.append(made(*a)) or plans[-1])
    out = embedding_dedup.dedup(planted_pairs(spark, 50_000, mean))
    share = out.where("n_links > 0").count() / 100_000
    passes = plans[0].first()["passes"]
    print(f"mean {mean}: {passes} passes, {share:.4f} of the rows found")
    assert share >= 0.99 and (mean == 0.7 or passes > 1)


def test_groups_of_a_window_are_compared_in_full(spark):
    out = embedding_dedup.dedup(planted_pairs(spark, embedding_dedup.NEIGHBOURS // 2, 0.7))
    assert out.where("n_links = 0").count() == 0


def test_groups_that_need_too_many_passes_are_compared_in_full(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "MOST_PASSES", 1)
    out = embedding_dedup.dedup(planted_pairs(spark, 2_000, 0.7))
    assert out.where("n_links = 0").count() == 0


def test_codes_order_like_sign_strings():
    x = np.random.default_rng(2).normal(size=(50, 8))
    c = embedding_dedup.codes(x, 2, 10)
    signs = (x @ embedding_dedup.projections(8, 2, 10) > 0).astype(int)
    for p in range(2):
        names = ["".join(map(str, s)) for s in signs[:, 10 * p : 10 * p + 10]]
        assert [int(n, 2) for n in names] == c[:, p].tolist()


def test_queries_over_the_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op3_ngram_join"](spark, sf).collect()), key=repr)
    assert got == brute(docs, Fraction(85, 100), 4)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted((tuple(r) for r in QUERIES["op2_embedding_dedup"](spark, sf).collect()), key=repr) == all_pairs(rows, 0.93)
