from __future__ import annotations

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardloom.llm import token_counts
from cardloom.llm.remembered import Remembered

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def plain(text: str) -> list[int]:
    return [len(e.ids) for e in LIBRARY.encode_batch([text[:i] for i in range(len(text) + 1)], add_special_tokens=False)]


def prefix_counts(*texts: str) -> list[list[int]]:
    return [token_counts.counts(s.tobytes()).tolist() for s in token_counts.counter(PATH).steps(list(texts))]


ODD = [
    "",
    "don't we'll 're \n\n  x\t y   ",
    "  \n \n\nab   ",
    "x<|endoftext|>y  <|endoftext|> <|endoftext|>",
    "<|endoftext",
    "été 你好你 \U0001f600\U0001f600   x",
    "'''re'r'll 'l'",
    " " * 70 + "x" + "\n" * 40 + "y",
    "a" * 300 + "=" * 90 + "1234567890" * 9,
    "՘꟎   x",
    "a  b 　c  d",
]


@pytest.mark.parametrize("text", ODD)
def test_every_prefix_as_the_library_has_it(text):
    assert prefix_counts(text) == [plain(text)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'srelt \n\t.,1é你<|>"), max_size=40), min_size=1, max_size=4))
def test_every_prefix_of_any_text(texts):
    assert prefix_counts(*texts) == [plain(t) for t in texts]


def test_classes_of_common_code_points():
    # What the pattern of this module takes for a letter, a number or a blank, the tokenizer does too.
    common = [c for c in map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)) if not token_counts.COMMON.search(c)]
    counter = token_counts.counter(PATH)
    text = "".join(f"a{c}1{c}!{c}\n" for c in common)
    assert len(common) > 30_000
    at, cuts = 0, []
    for piece in counter.pattern.findall(text):
        cuts.append((at, at + len(piece)))
        at += len(piece)
    assert cuts == [span for _, span in counter.own_cut.pre_tokenize_str(text)]


def test_whole_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    table = token_counts.prefix_table(docs, PATH)
    found = {r[0]: r[1:] for r in table.select("doc_id", "n_bytes", "n_chars", token_counts.token_count("steps")).collect()}
    for key, text in docs.collect():
        assert found[key] == (len((text or "").encode()), len(text or ""), len(LIBRARY.encode(text or "", add_special_tokens=False).ids))


def test_questions_about_prefixes(spark, frame):
    rnd = random.Random(3)
    texts = [None, *ODD, *("".join(rnd.choice("the quick brown fox 's\n") for _ in range(60)) for _ in range(5))]
    docs = frame("doc_id long, text string, steps int, key string", *[(i, t, 1, "k") for i, t in enumerate(texts)], (None, "null key", 2, None))
    table = token_counts.prefix_table(docs, PATH).cache()
    assert table.where("doc_id is null").count() == 1
    asked = table.select(
        "doc_id",
        token_counts.tokens_before("steps", F.lit(7)),
        token_counts.chars_within("steps", F.lit(4)),
        token_counts.chars_within("steps", F.lit(-1)),
    )
    cut = {r["doc_id"]: r["text"] for r in token_counts.truncate(docs, table, 4).collect()}
    for key, before, within, none in asked.where("doc_id is not null").collect():
        text = texts[key] or ""
        counts = plain(text)
        assert before == counts[min(7, len(text))] and none == -1
        assert within == max(i for i, n in enumerate(counts) if n <= 4)
        assert cut[key] == (None if texts[key] is None else text[:within])


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.prefix_table(none, PATH).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.PrefixCounter(public_tokenizers.path("word_bpe_49k.json"))


def test_remembering_is_bounded_and_learns_once_per_generation():
    import numpy as np

    learned = []

    def learn(words):
        learned.extend(words)
        return np.array([int(c) for w in words for c in w], np.int64), np.array([len(w) for w in words], np.int64)

    held = Remembered(learn, np.int64, 10)
    for i in range(40):
        words = [str(1000 + i), "7", "123"]
        table = held.ensure(set(words))
        flat, size = table.gather(table.rows(words, 3))
        assert flat.tolist() == [int(c) for w in words for c in w] and size.tolist() == [4, 1, 3]
        assert len(held.now.index) <= 10
    assert learned.count("7") == 1 and learned.count("123") == 1
