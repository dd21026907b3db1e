"""The pipeline, stage by stage, against plain Python over the same models."""

from __future__ import annotations

import inspect
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipe
from cardloom.llm import language_id, quality
from cardloom.llm.queries import ORACLES, QUERIES, remainder
from cardloom.llm.shipping import ship
from tests.llm.test_native import spans_of
from tests.llm.test_sequences import check_packed
from tests.llm.test_sets import brute

SF = "/root/testdata/sf0.001"


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=repr)


def test_the_stages_are_those_dealt():
    assert [n for n, _ in pipe.STAGES] == ["quality classifier", "language ID", "n-gram Jaccard join", "secret scans", "packing"]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in pipe.STAGES)
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_equal_plain_python(spark, docs):
    first = pipe.keep_quality(spark, docs, SF)
    assert first.columns == docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(remainder("doc_id", 5) != 0)
    model = quality.train(docs, labels)
    given = texts(docs)
    keep = [s >= pipe.LEAST_QUALITY for s in model.score([t for _, t in given])]
    assert texts(first) == [d for d, ok in zip(given, keep) if ok] and 0 < sum(keep) < len(keep)

    second = pipe.keep_language(spark, first, SF)
    names, _, score = language_id.train(first.where(remainder("doc_id", 4) != 2)).label([t for _, t in texts(first)])
    assert texts(second) == [d for d, n, s in zip(texts(first), names, score) if n != "und" and s >= pipe.LEAST_CERTAINTY]

    third = pipe.keep_one_of_group(spark, second, SF)
    groups = brute(texts(second), pipe.LIKENESS, pipe.WORDS)
    assert [k for k, _ in texts(third)] == sorted((r[0] for r in groups if r[0] == r[2]), key=repr)

    fourth = pipe.mask_secrets(spark, third, SF)
    assert fourth.columns == docs.columns
    for (k, before), (j, after) in zip(texts(third), texts(fourth)):
        hidden = {i for a, _, e, _ in spans_of(before) for i in range(a, e)}
        assert k == j and after == "".join("*" if i in hidden else c for i, c in enumerate(before))

    last = pipe.pack(spark, fourth, SF).collect()
    check_packed(last, texts(fourth), 2048)


def test_without_languages_every_text_with_a_letter_stays(spark, docs):
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, "123 !? ²"), (9004, "ж"), (None, "a")], "doc_id long, text string")
    rows = docs.unionByName(odd, allowMissingColumns=True).withColumn("lang", F.lit(None).cast("string"))
    out = pipe.keep_language(spark, rows, SF)
    assert out.columns == docs.columns
    assert texts(out) == [d for d in texts(rows) if language_id.has_letter(d[1])] and out.where("lang is not null").count() == 0


def test_run_applies_all_stages(spark):
    out = pipe.run(spark, SF)
    assert out.select("doc_id").distinct().count() > 100
    assert sum(r["length"] for r in out.collect()) > 10_000


def test_odd_rows_pass_through_all_stages(spark, docs):
    odd = [(9001, None), (9002, ""), (9003, "123 456"), (None, "the and of with " * 5), (9004, "a " * 100_000), (9005, "token=abcdefgh the of and in to")]
    rows = spark.createDataFrame([(k, t, None, None, None, 1) for k, t in odd] * 2, "doc_id long, text string, lang string, source string, n_chars long, _score int")
    both = docs.withColumn("_score", F.lit(0)).unionByName(rows)
    for name, stage in pipe.STAGES[:-1]:
        before = both
        both = stage(spark, both, SF).checkpoint()
        assert sorted(both.columns) == sorted(before.columns), name
    kept = {r["doc_id"] for r in both.select("doc_id").collect()}
    assert not kept & {9001, 9002, 9003}
    assert pipe.pack(spark, both, SF).count() >= both.count() > 100
    nothing = docs.limit(0)
    for _, stage in pipe.STAGES:
        nothing = stage(spark, nothing, SF)
        assert nothing.count() == 0
        if "doc_tokens" in nothing.columns:
            break


def test_the_language_cut_keeps_clean_texts_however_short_or_mixed(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang is not null and length(text) > 600")
    train, held = (rows.where(remainder("doc_id", 4) != 2), rows.where(remainder("doc_id", 4) == 2))
    model = language_id.train(train)
    rnd, by = random.Random(1), {}
    for r in held.select("lang", "text").collect():
        by.setdefault(r["lang"], []).append(r["text"].split())

    def words(lang, n):
        found = rnd.choice(by[lang])
        at = rnd.randrange(max(1, len(found) - n))
        return found[at : at + n]

    def mixed():
        a, b, c = rnd.sample(sorted(by), 3)
        return " ".join(words(a, 40) + words(b, 27) + words(c, 23))

    def lost(made):
        _, _, certain = model.label(made)
        return sum(c < pipe.LEAST_CERTAINTY for c in certain) / len(made)

    assert lost([mixed() for _ in range(300)]) < 0.02
    assert lost([" ".join(words(rnd.choice(sorted(by)), 2)) for _ in range(300)]) < 0.05
    assert lost([" ".join(w) for v in by.values() for w in v[:100]]) == 0


def test_languages_are_told_once_though_filtered_and_filled_in(spark):
    ship(spark)
    rows = spark.createDataFrame([(1, "Guten Tag ihr", "de"), (2, "the good day", "en"), (3, "the day", None)], "doc_id long, text string, lang string")
    model = language_id.fit([("de", "Guten Tag ihr Leute " * 9), ("en", "the good day of people " * 9)], steps=1)
    out = language_id.identify(rows, model, certainty_out="certain").where("lang_pred <> 'und' and certain >= 0")
    out = out.select("doc_id", F.coalesce("lang", "lang_pred").alias("lang"))
    assert out._jdf.queryExecution().executedPlan().toString().count("EvalPython") == 1
    assert {r["doc_id"] for r in out.collect() if r["lang"]} == {1, 2, 3}
