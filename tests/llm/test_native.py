"""Sharding, fingerprints and secret scans against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from cardloom.llm import fingerprints, secret_scan, sharding
from cardloom.llm.shared import chunk_pairs, components, gapless, key_cells, small_table

SCHEMA = "doc_id long, text string, lang string, _bucket int, shard string, spans string, blob string"


@pytest.fixture()
def docs(spark):
    long = "word " * 30_000 + "token=abcdefgh"
    texts = [None, "", "one two", "one two", "a b c d e f g h", "ünï cödé 😀 " * 9, "password: hunter22", long, "x" * 5000]
    rows = [(i, t, None, 7, "s", "z", "b") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[2], (None, "no key", "en", 1, "", "", "")], SCHEMA)


def chained(*values) -> int:
    seed = 42
    for v in values:
        data = v.to_bytes(8, "little", signed=True) if isinstance(v, int) else v
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def shard_of(doc: int, weights) -> int:
    def draw(s):
        seed = xxhash.xxh64_intdigest(s.to_bytes(4, "little"), chained(doc))
        return -math.log(((seed >> 11) + 0.5) / 2**53) / weights[s]

    return min((s for s in range(len(weights)) if weights[s] > 0), key=lambda s: (draw(s), s))


def test_shards_equal_plain_rendezvous(docs):
    out = sharding.shard_records(docs, [1, 2, 0, 4], [1, 2, 0, 4, 1]).collect()
    assert len(out) == docs.count()
    for r in out:
        if r["doc_id"] is not None:
            assert r["shard"] == shard_of(r["doc_id"], [1, 2, 0, 4])
            assert r["grown_shard"] == shard_of(r["doc_id"], [1, 2, 0, 4, 1])
        assert r["shard"] != 2 and r["grown_shard"] in (r["shard"], 4)
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    by = {(r["doc_id"], r["size"], r["text_crc32"]) for r in out}
    for r in docs.collect():
        data = (r["text"] or "").encode()
        assert (r["doc_id"], len(data) + 1, zlib.crc32(data)) in by


def test_shards_need_a_weight_and_follow_it(spark):
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), [0.0])
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id").withColumn("text", F.lit("t"))
    share = {r["shard"]: r["count"] / 20_000 for r in sharding.shard_records(rows, [1, 3]).groupBy("shard").count().collect()}
    assert abs(share[1] - 0.75) < 0.02
    assert sharding.shard_records(rows.limit(0), [1.0]).count() == 0


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", text.lower()) if w]


def shingles_of(text, n=5):
    w = words_of(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_edited_texts_and_neighbours(docs):
    out = fingerprints.edit_with_next(docs).collect()
    given = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for i, (doc, t) in enumerate(given):
        half = len(t) // 2
        want.append((doc, t, t[: len(t) - half] + given[(i + 1) % len(given)][1][:half]))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r["doc_id"], r["text"], r["edited"]) for r in out), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("outliers", [[], [-(2**40), 2**60]])
def test_order_holds_over_many_buckets_and_outliers(spark, outliers):
    ids = [*range(0, 900, 3), 5, 5, *outliers]
    rows = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    cells = fingerprints.in_order(rows, "doc_id", per_bucket=10)
    assert outliers or cells.select("_bucket").distinct().count() > 5
    assert cells.where("not _copy").count() == len(ids)
    order = sorted((i, f"t{i}") for i in ids)
    near = {a: b for a, b in zip([i for i, _ in order], [t for _, t in order[1:] + order[:1]])}
    out = fingerprints.edit_with_next(rows).collect()
    for r in out:
        if r["doc_id"] != 5:
            half = len(r["text"]) // 2
            assert r["edited"][len(r["text"]) - half :] == near[r["doc_id"]][:half]


def test_sketches_estimate(spark):
    base = [f"w{i}" for i in range(3000)]
    a, b = " ".join(base), " ".join(base[1000:] + [f"v{i}" for i in range(1000)])
    rows = spark.createDataFrame([(a, b), ("", ""), ("x y", None), ("x y", "X  y")], "a string, b string")
    s, t = fingerprints.sketch(F.col("a"), 256), fingerprints.sketch(F.col("b"), 256)
    out = rows.select(
        fingerprints.resemblance(s, t, 256).alias("r"), fingerprints.containment(s, t, 256).alias("c"), fingerprints.distinct_count(s, 256).alias("n")
    ).collect()
    x, y = shingles_of(a), shingles_of(b)
    assert abs(out[0]["r"] - len(x & y) / len(x | y)) < 0.1
    assert abs(out[0]["c"] - len(x & y) / len(x)) < 0.15
    assert abs(out[0]["n"] - len(x)) < 0.2 * len(x)
    assert [tuple(r)[:2] for r in out[1:]] == [(1.0, 1.0), (0.0, 0.0), (1.0, 1.0)]


def test_merged_sketches_equal_the_sketch_of_the_union(spark):
    rows = spark.createDataFrame([(1, "a b c d e f"), (1, "c d e f g h"), (2, ""), (1, None)], "k int, text string")
    parts = rows.select("k", fingerprints.sketch(F.col("text"), 4).alias("sketch"))
    merged = {r["k"]: r["sketch"] for r in fingerprints.merge_parts(parts, ["k"], k=4).collect()}
    every = rows.select(F.explode(fingerprints.shingle_hashes(F.coalesce("text", F.lit("")))).alias("h"), "k").where("k = 1")
    assert merged[1] == sorted({r["h"] for r in every.collect()})[:4] and merged[2] == []


BASE = (
    ("assign", re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
)


def spans_of(text):
    out = [(m.start(), n, m.end(), kind) for n, (kind, p, g, least) in enumerate(BASE) for m in p.finditer(text) if len(m[g]) >= least]
    return sorted(out)


TRICKY = [
    "token=token: abcdefgh", "PASSWORD = 'abc' secret:\"longenough1\"", "😀 api_key=ABCDEF😀apikey=x token=abcdef",
    "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + " xAKIAAKIA" + "C" * 20, "f" * 23 + " " + "0123456789abcdef" * 2,
    "secret=deadbeefdeadbeefdeadbeefdeadbeef", "ſecret=abcdefgh toKen=abcdefgh", "passwd" * 50, "token==a=b=c=d", "",
]


def test_findings_equal_plain_patterns(spark, docs):
    more = spark.createDataFrame([(100 + i, t, None, 1, "", "", "") for i, t in enumerate(TRICKY)], SCHEMA)
    both = docs.union(more)
    found, ledger = secret_scan.scan(both)
    got = sorted(((r["path"], [tuple(s) for s in r["spans"]]) for r in found.collect()), key=repr)
    want = sorted(((r["doc_id"], [(a, n, e, k) for a, n, e, k in spans_of(r["text"] or "")]) for r in both.collect()), key=repr)
    assert got == want
    blobs = {hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in both.collect()}
    assert ledger.count() == 3 * len(blobs)


def test_only_unseen_pairs_are_scanned(spark, docs):
    _, ledger = secret_scan.scan(docs)
    new = spark.createDataFrame([(50, "token=abcdefgh", None, 1, "", "", ""), (51, "one two", None, 1, "", "", "")], SCHEMA)
    added = secret_scan.update_ledger(secret_scan.address(new), ledger)
    assert {r["blob"] for r in added.collect()} == {hashlib.sha256(b"token=abcdefgh").hexdigest()}
    newer = (*secret_scan.RULES[:2], secret_scan.Rule("hex", "[0-9a-f]{8,}", version="2"))
    again = secret_scan.update_ledger(secret_scan.address(docs), ledger, newer)
    assert {r["rule"] for r in again.collect()} == {"hex@2"}
    found, whole = secret_scan.scan(new, ledger)
    assert {r["path"]: len(r["spans"]) for r in found.collect()} == {50: 1, 51: 0}
    assert whole.count() == ledger.count() + 3
    assert secret_scan.scan(docs.limit(0))[0].count() == 0


def test_masking_keeps_lengths(spark, docs):
    found = secret_scan.findings(secret_scan.update_ledger(secret_scan.address(docs)))
    out = secret_scan.mask(docs, found)
    assert out.count() == docs.count()
    assert out.columns == docs.columns
    before = {(r["doc_id"], r["text"]) for r in docs.collect()}
    for r in out.collect():
        if r["doc_id"] == 6:
            assert r["text"] == "*" * len("password: hunter22")
        elif r["doc_id"] == 7:
            assert r["text"].endswith(" " + "*" * 14) and len(r["text"]) == 150_014
        else:
            assert (r["doc_id"], r["text"]) in before


def test_gapless_and_cells(spark):
    rows = spark.range(1000).withColumn("g", F.when(F.col("id") % 3 == 0, 1).otherwise(2))
    out = gapless(rows, ["g"], ["id"], "n", 7).collect()
    for g in (1, 2):
        mine = sorted(r["n"] for r in out if r["g"] == g)
        assert mine == list(range(len(mine)))
    cells = key_cells(rows, "id", F.lit(1), 100)
    assert len({c.bucket for c in cells.rows}) >= 9
    assert key_cells(rows.limit(0), "id", F.lit(1), 100).rows == []
    assert small_table(spark, [(1, None), (2, 5)], "a long, b int").count() == 2


def test_components(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 200 + i) for i in range(30)]
    edges = spark.createDataFrame([*path, *star, (500, 500), (None, 1), (7, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, **{200 + i: 100 for i in range(30)}, 500: 500}
    assert components(edges.limit(0)).count() == 0
    with pytest.raises(RuntimeError, match="not settled in 2 rounds"):
        components(edges, rounds=2)


def test_chunk_pairs_let_all_rows_meet(spark):
    rows = spark.range(50).select(F.when(F.col("id") < 40, 1).otherwise(F.col("id")).alias("g"), F.col("id").alias("k"), F.lit(1).alias("w"))
    dealt = chunk_pairs(rows, "g", "k", "w", 10).collect()
    tasks = {}
    for r in dealt:
        tasks.setdefault(r["_task"], []).append(r)
    assert max(map(len, tasks.values())) < 40
    met = set()
    for part in tasks.values():
        for a in part:
            for b in part:
                if a["_low"] == a["_high"] or a["_chunk"] != b["_chunk"]:
                    met.add((a["k"], b["k"]))
    assert all((a, b) in met for a in range(40) for b in range(40))
