"""Packing, archives and sampled segmentations: exact round trips and brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardloom.llm import packing, segmentation, warc
from cardloom.llm.shipping import ship

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "it's 5's ,'s \"'s don't", "<|endoftext|> a<|ENDOFTEXT|>b <|startoftext|>x", "étion É́ ÀÉÎ ñÑ", "İstanbul ΣΑΣ σας",
    "a\xa0b\x0bc\x1cd\x85e", "²³ Ⅷ ªº µ×÷ ß ẞ", "foo...bar,,baz!?  12,345.67 a1b2c3", "日本語テキスト한국어 😀", "x" * 6000, "word " * 3000,
]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def test_units_encode_like_whole_texts():
    rng, letters = random.Random(1), "aéÉÑñ '’.,!?09 \n\t́ß²<|xKʰKİ\x1c\xa0"
    texts = [t or "" for t in ODD] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    whole = Tokenizer.from_file(WORDS)
    for text, ids in zip(texts, packing.WordEncoder(WORDS).encode(texts)):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def check_packed(rows, docs, window):
    whole = Tokenizer.from_file(WORDS)
    want = Counter((k, tuple([*whole.encode(t or "", add_special_tokens=False).ids, 1])) for k, t in docs)
    alike = {}
    for (key, ids), n in want.items():
        alike.setdefault((key, len(ids)), []).extend([np.array(ids, "<u4")] * n)
    mine = {}
    for r in rows:
        mine.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    assert set(mine) == set(alike)
    for name, copies in alike.items():
        # Every id of every copy lies in exactly one piece.
        held = np.zeros(name[1], int)
        for r in mine[name]:
            part = slice(r["start"], r["start"] + r["length"])
            assert any(zlib.crc32(ids[part].tobytes()) == r["ids_crc32"] for ids in copies)
            held[part] += 1
        assert (held == len(copies)).all()
    assert sum(r["length"] for r in rows) == sum(n * len(ids) for (_, ids), n in want.items())
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(by) == list(range(len(by)))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(by)


def test_documents_are_packed_whole(spark):
    rng = random.Random(5)
    docs = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "w " * rng.randrange(60)) for i in range(150)] + [(1, ""), (None, "no key")]
    rows = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id long, text string, start int, number int, length int")
    got = packing.pack_documents(rows, WORDS, window=64).collect()
    n = check_packed(got, docs, 64)
    assert n * 64 < 1.05 * sum(r["length"] for r in got)
    assert packing.pack_documents(rows.limit(0), WORDS).count() == 0


def test_plan_uses_every_piece_once_with_little_padding():
    rng = random.Random(2)
    for window, count in ((100, 0), (100, 30), (2048, 5000), (2048, 200_000)):
        sizes = Counter(min(window, max(1, int(rng.lognormvariate(math.log(window / 5), 0.9)))) for _ in range(count))
        check_plan(*packing.plan(dict(sizes), window), sizes, window)


def check_plan(places, windows, sizes, window):
    """Every token of every piece is placed once, windows are filled from 0 without gaps, and little is left empty."""
    token = {n: np.zeros((count, n), np.int8) for n, count in sizes.items()}
    starts = []
    for p in places:
        token[p.length][p.first : p.first + p.count, p.skip : p.skip + p.size] += 1
        assert p.skip % packing.GRAIN == 0 and p.size > 0
        starts += [(p.base + i, p.offset, p.size) for i in range(p.count)]
    assert all((t == 1).all() for t in token.values())
    filled = {}
    for w, offset, size in sorted(starts):
        assert filled.get(w, 0) == offset and offset + size <= window
        filled[w] = offset + size
    assert sorted(filled) == list(range(windows))
    total = sum(k * v for k, v in sizes.items())
    assert windows <= -(-total // (window - packing.GRAIN + 1)) + 1
    if len(sizes) > 1000:
        assert windows * window < 1.002 * total


@pytest.mark.parametrize("sizes", [{1200: 3000}, {1100: 2000, 1500: 1500}, {1: 5000}, {2048: 7}, {2047: 100, 3: 1}, {1025: 999, 2048: 3}])
def test_tables_with_few_lengths_have_little_padding(sizes):
    check_plan(*packing.plan(sizes), sizes, packing.WINDOW)


def test_crc_of_parts():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 50_000, 300).astype("<u4")
    cuts = [(0, 16), (16, 300), (32, 48), (160, 161), (0, 300)]
    before = np.array([zlib.crc32(ids[:a].tobytes()) for a, _ in cuts], np.uint64)
    upto = np.array([zlib.crc32(ids[:b].tobytes()) for _, b in cuts], np.uint64)
    got = packing.crc_between(before, upto, np.array([b - a for a, b in cuts]), 512)
    assert got.tolist() == [zlib.crc32(ids[a:b].tobytes()) for a, b in cuts]


def test_documents_of_one_length_fill_their_windows(spark):
    docs = [(i, " ".join(["word"] * 39)) for i in range(200)] + [(500, "word " * 200)]
    got = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), WORDS, window=64).collect()
    n = check_packed(got, docs, 64)
    assert n <= -(-sum(r["length"] for r in got) // 49) + 1


def test_nnls_solves_what_can_be_solved():
    columns = [(7, 3), (5, 5), (4, 3, 3), (8, 2)]
    truth = np.array([40, 11, 0, 6])
    goal = np.zeros(11)
    for parts, n in zip(columns, truth):
        for p in parts:
            goal[p] += n
    assert np.allclose(packing.nnls(columns, goal, 400), truth, atol=0.01)
    assert (packing.nnls(columns, np.array([0, 0, 9.0] + [0] * 8)) >= 0).all()


PAGES = [
    (1, "http://a/1", "x" * 1000), (5, "http://a/5", "x" * 1000), (3, None, "x" * 1000), (4, "http://a/4", "x" * 999), (6, "u", "x" * 999),
    (7, "bad url\r\nWARC/1.1", "é" * 500), (8, "", None), (9, "u", ""), (None, "nokey", "y" * 2000), (None, "nokey2", "z" * 1500),
    (10, "u", "z" * 1500), (11, "u", "\r\n\r\nWARC/1.1\r\n" * 90), (2, "u", "head\r\n\r\nbody"), (2, "u", "other"), (2, "u", "other"),
]
PAGE_SCHEMA = "page_id long, url string, html string, shard int, digest string"


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, 1, "d") for p in PAGES], PAGE_SCHEMA)
    manifest = warc.write_archive(pages, str(tmp_path / "a"), file_bytes=700, shard_bytes=3000)
    files = manifest.collect()
    assert len(files) > 3 and sum(f["records"] for f in files) == len(PAGES)
    for f in files:
        data = (tmp_path / "a" / f["file"]).read_bytes()
        assert hashlib.sha256(data).hexdigest() == f["sha256"] and len(data) == f["bytes"]
    assert not [p for p in Path(tmp_path / "a").iterdir() if p.name.startswith(".shard")]
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_archive(spark, str(tmp_path / "a")).collect()), key=repr)
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        last = max((p[0] for p in PAGES if (p[2] or "") == (html or "") and p[0] is not None), default=None)
        refers = last if len(data) >= 1000 and last is not None and page != last else None
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers))
    assert got == sorted(want, key=repr)
    texts = {r["page_id"]: r["html"] for r in warc.read_archive(spark, str(tmp_path / "a")).where("record_type = 'response'").collect()}
    assert texts[11] == "\r\n\r\nWARC/1.1\r\n" * 90 and texts[8] == ""


def test_equal_pages_give_equal_files(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * (i % 50)) for i in range(400)], "page_id long, url string, html string")
    first = warc.write_archive(pages, str(tmp_path / "a"), file_bytes=4000, shard_bytes=20_000).collect()
    again = warc.write_archive(pages.repartition(5).orderBy(F.desc("page_id")), str(tmp_path / "b"), file_bytes=4000, shard_bytes=20_000).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again)) and len(first) > 4
    (tmp_path / "a" / ".shard-000000-00000.warc.gz.left").write_bytes(b"junk of a lost task")
    assert warc.read_archive(spark, str(tmp_path / "a")).count() == 400
    empty = warc.write_archive(pages.limit(0), str(tmp_path / "c"))
    assert empty.count() == 0 and warc.read_archive(spark, str(tmp_path / "c")).count() == 0


def test_damage_is_found(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text " * 50)], "page_id long, url string, html string")
    name = warc.write_archive(pages, str(tmp_path)).first()["file"]
    import gzip

    data = gzip.decompress((tmp_path / name).read_bytes()).replace(b"text text", b"text tesT")
    (tmp_path / name).write_bytes(gzip.compress(data))
    with pytest.raises(Exception, match="wrong block digest"):
        warc.read_archive(spark, str(tmp_path)).collect()


def segmentations(lattice, entry, after=()):
    """All paths of a run with their log probabilities."""
    out = []
    for e in lattice.options(int(lattice.first[entry])):
        p, target = float(lattice.logp[e]), int(lattice.next[e])
        ids = tuple(lattice.pieces(np.array([e])).tolist())
        out += [(ids, p)] if target < 0 else [(ids + more, p + q) for more, q in segmentations(lattice, target)]
    return out


@pytest.fixture(scope="module")
def pieces():
    return segmentation.Lattice(PIECES)


def test_edges_have_the_probabilities_of_all_paths(pieces):
    (entry,) = next(iter(pieces.entries(["hello"])))
    paths = segmentations(pieces, int(entry))
    assert sum(math.exp(p) for _, p in paths) == pytest.approx(1)
    assert len({ids for ids, _ in paths}) == len(paths) > 10
    raw = pieces.raw
    assert all(b"".join(raw[i] for i in ids) == b" hello" for ids, _ in paths)


def test_samples_are_distinct_and_follow_the_probabilities(pieces):
    (entries,) = pieces.entries(["the a"])
    runs = [segmentations(pieces, int(e)) for e in entries]
    exact = {sum((p[0] for p in c), ()): math.exp(sum(p[1] for p in c)) for c in itertools.product(*runs)}
    assert sum(exact.values()) == pytest.approx(1)
    first, pairs, n = Counter(), Counter(), 4000
    for out in segmentation.sample_many(pieces, [entries] * n, list(range(n)), 2):
        names = [tuple(ids.tolist()) for ids, *_ in out]
        assert len(set(names)) == 2 and out[0][2] >= out[1][2]
        for (ids, logp, _, score), name in zip(out, names):
            assert math.exp(logp) == pytest.approx(exact[name]) and 0 < score <= 1
        first[names[0]] += 1
        pairs[tuple(names)] += 1
    for name, p in exact.items():
        assert abs(first[name] / n - p) < 4 * math.sqrt(p * (1 - p) / n) + 1e-3
    top = sorted(exact, key=exact.get)[-2:]
    for a, b in (top, top[::-1]):
        p = exact[a] * exact[b] / (1 - exact[a])
        assert abs(pairs[a, b] / n - p) < 4 * math.sqrt(p * (1 - p) / n) + 1e-3


def test_inclusion_scores_are_unbiased(pieces):
    (entries,) = pieces.entries(["the a"])
    total = 0.0
    for out in segmentation.sample_many(pieces, [entries] * 1500, list(range(1500)), 3):
        for _, logp, _, score in out:
            total += math.exp(logp) / score
    assert total / 1500 == pytest.approx(1, abs=0.05)


def test_few_segmentations_are_all_given(pieces):
    (entries,) = pieces.entries(["a"])
    runs = segmentations(pieces, int(entries[0]))
    (out,) = segmentation.sample_many(pieces, [entries], [7], 50)
    assert {tuple(ids.tolist()) for ids, *_ in out} == {ids for ids, _ in runs} and all(s == 1.0 for *_, s in out)


def paths(lattice, text) -> float:
    """The number of segmentations of a text: over its runs, the product of the numbers of paths."""

    def count(state: int) -> int:
        following = [int(lattice.next[e]) for e in lattice.options(int(lattice.first[state]))]
        return sum(1 if t < 0 else count(t) for t in following)

    (entries,) = lattice.entries([text])
    return math.prod(count(int(e)) for e in entries) if len(text) < 25 else math.inf


def test_encoding_and_decoding(spark, pieces):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "no key  two blanks "), (50, "\n\t ▁ \x00")]
    rows = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, ids string")
    out = segmentation.encode(rows, PIECES, k=3)
    back = [(r["doc_id"], r["sample"], r["t"], tuple(r["ids"]), r["value"]) for r in out.withColumn("t", segmentation.decode(F.col("ids"), PIECES)).collect()]
    want = {(k, (t or "").replace("▁", " ")) for k, t in docs}
    assert {(k, t) for k, _, t, _, _ in back} == want
    for k, t in docs:
        if k != 3 and t:
            assert len({ids for key, _, _, ids, _ in back if key == k}) == min(3, paths(pieces, t))
    assert [ids for k, _, _, ids, _ in back if k in (0, 1)] == [(), ()]
    twice = Counter((s, ids, v) for k, s, _, ids, v in back if k == 3)
    assert set(twice.values()) == {2}
    again = segmentation.encode(rows.repartition(3), PIECES, k=3)
    assert sorted((r["doc_id"], r["sample"], tuple(r["ids"])) for r in again.collect() if r["doc_id"] is not None) == sorted((k, s, ids) for k, s, _, ids, _ in back if k is not None)
    assert segmentation.encode(rows.limit(0), PIECES).count() == 0


def test_lattices_stay_small_and_common_runs_are_kept(pieces, monkeypatch):
    monkeypatch.setattr(segmentation, "MOST_EDGES", 6000, raising=False)
    small = segmentation.Lattice(PIECES)
    first = int(next(small.entries(["common"]))[0])
    learned = []
    learn = small.learn
    monkeypatch.setattr(small, "learn", lambda code, *size: learned.append(len(code)) or learn(code, *size))
    for i in range(60):
        text = " ".join(["common", *(f"w{i}x{j}" for j in range(50))])
        got, want = next(small.entries([text])), next(pieces.entries([text]))
        assert [segmentations(small, int(e)) for e in got[:4]] == [
            [(ids, pytest.approx(p)) for ids, p in segmentations(pieces, int(e))] for e in want[:4]
        ]
        assert small.used <= 9000
    assert first >= 0 and len(learned) == 60
    before = len(learned)
    next(small.entries(["common"]))
    assert len(learned) == before


def test_units_are_looked_up_once_a_block(monkeypatch):
    from cardloom.llm.remembered import Table

    looked, rows_of = [], Table.rows
    monkeypatch.setattr(Table, "rows", lambda self, words, count: looked.append(count) or rows_of(self, words, count))
    enc = packing.WordEncoder(WORDS)
    looked.clear()
    texts = ["The cat, the dog; THE cat! " * 200, "", " \n", "don't  the <|x|> ", "Ärger é ŉ " * 50, "日本 the\tcat"]
    ids, size = enc.flat(texts)
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for x in want for i in x] and size.tolist() == [len(x) for x in want]
    assert sum(looked) < 40


def test_units_are_hashed_learned_and_remembered_in_bounded_memory(monkeypatch):
    import tracemalloc

    from cardloom.llm import remembered

    text = "abcd" * 500_000
    code, size = remembered.codes(text), np.full(500_000, 4)
    tracemalloc.start()
    hashed = remembered.hashes(code, np.cumsum(size) - size, size)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(hashed.tolist())) == 1 and peak < 5 * hashed.nbytes
    long = remembered.hashes(code, np.array([0, 4, 0]), np.array([4, 1_900_000, 4]))
    assert long[0] == long[2] == hashed[0] != long[1]
    monkeypatch.setattr(packing, "UNITS_AT_ONCE", 50, raising=False)
    monkeypatch.setattr(packing, "MOST_WORDS", 900)
    enc, asked = packing.WordEncoder(WORDS), []
    learn = enc.learn
    monkeypatch.setattr(enc, "learn", lambda units: asked.append(len(units)) or learn(units))
    whole = Tokenizer.from_file(WORDS)
    for i in range(30):
        texts = [f"common, q{i}x{j}! common" for j in range(100)]
        for t, ids in zip(texts, enc.encode(texts)):
            assert ids.tolist() == whole.encode(t, add_special_tokens=False).ids
        assert len(enc.held.now.hashes) <= 900 and len(enc.held.before.hashes) <= 900
    assert max(asked) <= 50


def test_decoding_needs_no_python_worker(spark, pieces):
    raw = [b"\xe6\x97", b"\xf0\x9f\x98", b"a\xffb", b"\xc0\xaf", b"\xed\xa0\x80", b" \xe6\x97\xa5", b"\xf4\x90\x80\x80z", b"  b", b" ", b"\0", b""]
    rows = spark.createDataFrame([(i, [pieces.byte[x] for x in b]) for i, b in enumerate(raw)] + [(99, None)], "i int, ids array<int>")
    out = rows.withColumn("t", segmentation.decode(F.col("ids"), PIECES))
    want = {i: t[1:] if t[:1] == " " else t for i, t in enumerate(b.decode("utf-8", "replace") for b in raw)} | {99: None}
    assert {r["i"]: r["t"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "from_json" not in plan


def test_a_long_path_is_valued_no_further_than_it_can_matter(pieces, monkeypatch):
    texts = ["the quick brown fox jumps over a lazy dog 日本 " * n for n in (1, 30, 1000)] + ["", "a", "▁ x"]
    entries, keys = list(pieces.entries(texts)), list(range(len(texts)))
    valued = []
    truncated = segmentation.truncated
    monkeypatch.setattr(segmentation, "truncated", lambda place, *rest: valued.append(np.size(place)) or truncated(place, *rest))

    def samples():
        found = segmentation.sample_many(pieces, entries, keys, 3)
        return [[(ids.tolist(), logp, value, score) for ids, logp, value, score in rows] for rows in found]

    short = samples()
    total = sum(len(ids) for rows in short for ids, *_ in rows)
    assert total > 10_000 and sum(valued) < total / 10
    # As when every place is valued, from the first or after those before it did not settle it.
    for far in (1e9, 1.0):
        monkeypatch.setattr(segmentation, "FAR", far, raising=False)
        assert samples() == short


def test_sums_over_ways_are_equal_with_and_without_logs(monkeypatch):
    texts = ["hello wörld 日本語テキスト 😀😀😀 a\tb " + "x" * 30, "", "  two  blanks ", "日" * 3000 + " end", "e" * 5000]
    logs = []
    for longest in (600.0, -1.0):
        monkeypatch.setattr(segmentation, "LONGEST_WAY", longest, raising=False)
        lattice = segmentation.Lattice(PIECES)
        entries = list(lattice.entries(texts))
        assert [len(e) for e in entries] == [6, 0, 3, 2, 1]
        logs.append((lattice.logp[: lattice.used].copy(), lattice.cut[: lattice.used].copy(), lattice.next[: lattice.used].copy()))
    assert all(np.allclose(a, b, rtol=0, atol=1e-9) and np.isfinite(a).all() for a, b in zip(*logs))
