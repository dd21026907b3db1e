"""Language ID and quality: gradients, edge texts and held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.llm import language_id, quality
from cardloom.llm.learning import labelled_sample
from cardloom.llm.queries import QUERIES, remainder
from cardloom.llm.shipping import ship

SF = "/root/testdata/sf0.01"


def numeric(loss, w, k, i, e):
    w[k][i] += e
    a = loss()
    w[k][i] -= 2 * e
    b = loss()
    w[k][i] += e
    return (a - b) / (2 * e)


def test_gradients_through_time():
    rng = np.random.default_rng(0)
    w = language_id.new_weights(3, 4, rng)
    x, y = rng.integers(65, 200, (5, 12)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    _, g = language_id.loss_and_gradients(w, x, y)
    for k in w:
        i = tuple(int(rng.integers(s)) for s in w[k].shape)
        i = (int(x[0, 3]), *i[1:]) if k[0] == "x" else i
        assert g[k][i] == pytest.approx(numeric(lambda: language_id.loss_and_gradients(w, x, y)[0], w, k, i, 1e-5), rel=1e-3, abs=1e-7)


def test_gradients_of_attention():
    rng = np.random.default_rng(0)
    w = {k: v.astype(float) for k, v in quality.new_weights(rng).items()}
    x = rng.integers(1, 120, (7, 40)).astype(np.uint8)
    x[3, 10:] = 0
    owner, y = np.array([0, 0, 1, 1, 1, 2, 2]), np.array([1, 0, 1])
    _, g = quality.loss_and_gradients(w, x, owner, y)
    for k in w:
        i = tuple(int(rng.integers(s)) for s in w[k].shape)
        i = (int(quality.pair_codes(x)[0, 3]), *i[1:]) if k == "e" else i
        assert g[k][i] == pytest.approx(numeric(lambda: quality.loss_and_gradients(w, x, owner, y)[0], w, k, i, 1e-3), rel=2e-2, abs=1e-6)


def test_the_fast_states_equal_the_trained_ones():
    rng = np.random.default_rng(1)
    w = language_id.new_weights(2, 5, rng)
    x = rng.integers(0, 256, (3, 20)).astype(np.uint8)
    slow, _ = language_id.forward(w, "f", x.T)
    fast = language_id.Model(["a", "b"], w).states("f", np.ascontiguousarray(x.T))
    assert np.allclose(slow, fast.transpose(0, 2, 1), atol=1e-5)


EDGES = [(1, None), (2, ""), (3, "1234 !? ²"), (4, "ж"), (5, "the and of " * 40_000), (5, "the and of " * 40_000), (None, "der die das")]


def test_language_of_odd_rows(spark):
    ship(spark)
    pairs = [("en", "the and of with that it was " * 9), ("de", "der die das und nicht schön ä ö " * 9)] * 4
    model = language_id.fit(pairs, steps=60)
    rows = spark.createDataFrame([(i, t, "x", 1.0, "f") for i, t in EDGES], "doc_id long, text string, lang_pred string, score double, _found string")
    out = language_id.identify(rows, model)
    assert sorted(out.columns) == ["_found", "doc_id", "lang_pred", "score", "text"]
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in out.collect()]
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert [g[1] for g in got if g[0] == 5] == ["en", "en"] and [g[1] for g in got if g[0] is None] == ["de"]
    assert all(0 <= g[2] <= 1 for g in got) and [g[1] for g in got if g[0] == 4][0] in ("en", "de")
    assert language_id.identify(rows.limit(0), model).count() == 0
    nothing = language_id.train(rows.select("doc_id", "text").withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language_id.identify(rows, nothing).collect()} == {"und"}


def test_long_texts_are_read_to_the_end():
    pairs = [("en", "the and of with that it was " * 9), ("de", "der die das und nicht sich für " * 9)] * 4
    model = language_id.fit(pairs, steps=80)
    p = model.probabilities(["the and of " * 100 + "der die das und " * 900, "der die das und " * 10])
    assert p[0].argmax() == model.languages.index("de") and 0.02 < p[0][model.languages.index("en")] < 0.3


def test_held_out_languages(spark):
    out = QUERIES["op1_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]
    assert len(held) > 200 and np.mean(held) > 0.98


def test_quality_of_odd_rows(spark):
    ship(spark)
    good, bad = "a b c plain words in a row. " * 30, "### %%% ### %%% " * 40
    model = quality.fit([(1, good), (0, bad), (1, good + "x"), (0, bad + "y")] * 8, epochs=12)
    rows = spark.createDataFrame([(i, t, 9.0, "s") for i, t in [*EDGES, (7, good), (8, bad)]], "doc_id long, text string, score double, _score string")
    got = [(r["doc_id"], r["score"]) for r in quality.score(rows, model).collect()]
    assert len(got) == len(EDGES) + 2 and all(0 <= s <= 1 for _, s in got)
    by = dict(got)
    assert by[1] == by[2] and by[7] > 0.7 > 0.3 > by[8]
    assert quality.score(rows.limit(0), model).count() == 0
    assert quality.fit([]).score(["x", None]).tolist() == [0.5, 0.5]
    assert quality.fit([(1, "a"), (1, "b")]).score(["x"]).tolist() == [1.0]


def test_attention_sums_to_one_and_finds_the_bad_passage():
    good, bad = "a b c plain words in a row. " * 40, "### %%% ### %%% " * 64
    model = quality.fit([(1, good * 3), (0, good * 2 + bad), (1, good * 2), (0, bad + good)] * 8, epochs=25)
    x, count = quality.windows([good * 2 + bad], quality.PASSAGE)
    h = quality.encode(model.weights, quality.features(model.weights, x)[0])
    weight, _ = quality.pool(quality.attention(model.weights, h)[0], h, np.zeros(len(h), int), 1)
    assert weight.sum() == pytest.approx(1) and len(weight) == count[0]
    assert model.score([good * 2 + bad])[0] < 0.5 < model.score([good * 2])[0]


def test_held_out_quality(spark):
    out = QUERIES["op4_quality"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    rows = [r for r in out.join(labels, "doc_id").collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.97
    assert np.mean([r["predicted"] for r in rows if r["quality"] == 1]) > 0.98


def test_the_sample_is_bounded_and_stable(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 100 == 0, "b").otherwise("a").alias("y"), F.repeat(F.lit("xyz "), F.lit(4000)).alias("t"))
    a = labelled_sample(rows, "y", "t", "id", 100, 4, 50)
    b = labelled_sample(rows.repartition(7), "y", "t", "id", 100, 4, 50)
    assert a == b and 60 < sum(k == "a" for k, _ in a) < 200 and sum(k == "b" for k, _ in a) == 50
    assert all(len(t) == 200 for _, t in a)
    assert spark.range(1).select(remainder("id", 4)).first()[0] == zlib.crc32(b"0") % 4


def test_every_label_is_sampled(spark):
    rows = spark.range(60_000).select("id", (F.col("id") % 600).cast("string").alias("y"), F.lit("xyz").alias("t"))
    sample = labelled_sample(rows, "y", "t", "id", 40, 4, 50)
    assert len({k for k, _ in sample}) == 600 and len(sample) < 2 * 256 * 40
