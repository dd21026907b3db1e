"""Exact token counts at every prefix of a text, by dynamic programming over a byte-level BPE.

The tokens of a prefix are those of a shorter prefix and one last token.  Of the vocabulary's tokens that end
at a place, exactly one can follow the last token before it: the one that no merge would join differently across
the border.  So the count at every place of a piece follows from the counts before it, without encoding any prefix.
Pieces are what the tokenizer's own pattern cuts a text into, and their counts add up.

The table keeps, for each document, the change of the count at every code point as one signed byte.  Questions
about prefixes (how many tokens has it, how much fits into a budget) are answered from the table alone.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cardloom.llm.remembered import Remembered
from cardloom.llm.shared import blocks, same_text

MOST_PIECES = 400_000
MOST_PAIRS = 500_000
#: Code points whose class is the same in every version of the character tables; a text with others is cut by the tokenizer.
COMMON = re.compile("[^\\u0000-\\u0557\\u1e00-\\u1eff\\u2010-\\u2064\\u20a0-\\u20bf\\u3000-\\u3029\\u3041-\\u3096\\u30a1-\\u30fa\\u4e00-\\u9fcc\\uac00-\\ud7a3]")


def byte_signs() -> str:
    """The sign of every byte in the vocabulary: itself if it is visible in Latin-1, else the next one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in visible else next(hidden)) for b in range(256))


class PrefixCounter:
    """Counts of a byte-level BPE tokenizer file (a ``tokenizers`` JSON with the byte-level pattern and no normalizer)."""

    def __init__(self, path: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec["normalizer"]:
            raise ValueError("prefix counts need a plain byte-level BPE tokenizer")
        plain = dict(zip(byte_signs(), map(chr, range(256))))
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        merges = [tuple("".join(map(plain.__getitem__, part)) for part in m) for m in merges]
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        if max(map(len, model["vocab"])) > 128:
            raise ValueError("a token of over 128 bytes: changes of the count would not fit a signed byte")
        self.ends = ahocorasick.Automaton()
        self.made_of = {"".join(p): p for p in merges}
        if len(self.made_of) < len(merges):
            raise ValueError("a token that two merges make")
        tokens = [*plain.values(), *self.made_of]
        for token in tokens:
            self.ends.add_word(token, (len(token), token))
        self.ends.make_automaton()
        # Fixed value: the pattern of byte-level BPE.
        self.pattern = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
        self.blank = regex.compile(r"\s")
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("only added tokens that are matched as they are")
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.own_cut = Tokenizer.from_file(path).pre_tokenizer
        self.pairs: dict[tuple[str, str], bool] = {}
        self.held = Remembered(self.learn, np.int8, MOST_PIECES)

    def edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """What stands at one edge (0: left, 1: right) of a token while it is made, and the rank of the merge that ends it."""
        found, rank = [], len(self.ranks)
        while True:
            found.append((token, rank))
            if len(token) == 1:
                return found
            parts = self.made_of[token]
            rank, token = self.ranks[parts], parts[side]

    def may_follow(self, left: str, right: str) -> bool:
        """Whether the tokens of both together are just these two: no merge across the border comes before those of both sides.

        Of two equal pairs the left one is merged first.
        """
        beside = self.edge(right, 0)
        for x, x_end in self.edge(left, 1):
            for y, y_end in beside:
                rank = self.ranks.get((x, y))
                if rank is not None and rank < x_end and rank <= y_end:
                    return False
        return True

    def byte_counts(self, text: str, counts: list[int]) -> None:
        """Add the token count after every byte of a piece, given as a character each, to ``counts``."""
        last: list[str] = []
        start = done = len(counts)
        pairs = self.pairs
        for end, (size, token) in self.ends.iter(text):
            end += start
            if end < done:
                continue
            before = end - size
            if before < start:
                counts.append(1)
            else:
                pair = last[before - start], token
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = self.may_follow(*pair)
                if not fits:
                    continue
                counts.append(counts[before] + 1)
            last.append(token)
            done += 1
        if done - start != len(text):
            raise ValueError("a prefix without a last token: the vocabulary has tokens that its merges do not make")

    def learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Changes of the count at every code point of pieces, as a text that ends there has it, and how many there are."""
        data = [p.encode() for p in pieces]
        counts: list[int] = []
        for piece, raw in zip(pieces, data):
            at = len(counts)
            self.byte_counts(raw.decode("latin-1"), counts)
            if raw[0] == 39 and len(raw) == 3 and piece[1:].isalpha():
                # A text that ends inside a contraction has an apostrophe and a letter.
                letter: list[int] = []
                self.byte_counts(piece[1], letter)
                counts[at + 1] = counts[at] + letter[0]
        if len(self.pairs) > MOST_PAIRS:
            self.pairs.clear()
        whole = np.frombuffer(b"".join(data) + b" ", np.uint8)
        ends = (whole[1:] & 0xC0) != 0x80
        found = np.array(counts, np.int64)[ends]
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        steps = np.diff(found, prepend=0)
        starts = np.cumsum(size) - size
        steps[starts] = found[starts]
        if len(steps) and (steps.min() < -128 or steps.max() > 127):
            raise ValueError("a change of the count does not fit a signed byte")
        return steps.astype(np.int8), size

    def cut(self, text: str) -> list[str]:
        if COMMON.search(text):
            return [text[a:b] for _, (a, b) in self.own_cut.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def plain_steps(self, texts: list[str]) -> list[np.ndarray]:
        """Changes of the count of texts, strings of added tokens being ordinary."""
        pieces = [self.cut(t) for t in texts]
        table = self.held.ensure(set().union(*pieces))
        flat = [p for one in pieces for p in one]
        steps, _ = table.gather(table.rows(flat, len(flat)))
        ends = np.cumsum([len(t) for t in texts])
        steps = np.split(steps.astype(np.int16), ends[:-1])
        for one, text, step in zip(pieces, texts, steps):
            self.mend_blanks(one, text, step)
        return steps

    def mend_blanks(self, pieces: list[str], text: str, steps: np.ndarray) -> None:
        """The place before a text: blanks at the end of a prefix are one piece, of which the last one leaves when a word follows."""
        if not _TWO_BLANKS.search(text):
            return
        at = 0
        for piece, after in zip(pieces, pieces[1:]):
            at += len(piece)
            if not piece[0].isspace() or not self.blank.match(piece) or not self.blank.match(after) or not self.blank.match(piece[-1]):
                continue
            run = piece + after[0]
            table = self.held.ensure({run, piece, after[0]})
            one, both, last = (int(table.gather(table.rows([x], 1))[0].sum()) for x in (piece, run, after[0]))
            more = both - one - last
            steps[at] += more
            if at + 1 < len(steps):
                steps[at + 1] -= more

    def steps(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the change of the token count at every code point; the sum up to a place is that prefix's count."""
        parts, shape = [], []
        for text in texts:
            some = self.cut_special.split(text) if self.cut_special and any(s in text for s in self.special) else [text]
            # Up to its last character an added token is ordinary text, joined to what stands before.
            joined = [some[i] + some[i + 1] for i in range(0, len(some) - 1, 2)]
            shape.append([len(s) for s in some[::2]])
            parts += [*joined, some[-1]]
        found = iter(self.plain_steps(parts))
        out = []
        for sizes in shape:
            row = []
            for i, size in enumerate(sizes):
                step = next(found)
                if i < len(sizes) - 1:
                    # At its end it is one token.
                    step[-1] = 1 - int(step[size:-1].sum(dtype=np.int64))
                row.append(step)
            whole = np.concatenate(row) if len(row) > 1 else row[0]
            if len(whole) and (whole.min() < -128 or whole.max() > 127):
                raise ValueError("a change of the count does not fit a signed byte")
            out.append(whole.astype(np.int8))
        return out


_TWO_BLANKS = re.compile(r"\s\s")


@lru_cache(1)
def counter(path: str) -> PrefixCounter:
    """One counter per worker process, kept over its tasks; what it remembers is bounded."""
    return PrefixCounter(path)


def prefix_table(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_chars, steps): the change of the token count at every code point, a signed byte each.

    A NULL text counts as empty and has no steps.  NULL keys and repeated rows stay as they are; other columns of
    ``docs`` do not matter.  Added tokens are found in a text as the library does by default.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = counter(tokenizer)
        for batch in batches:
            texts = batch.pop("text").tolist()
            for a, b in blocks(texts):
                steps = [s.tobytes() for s in known.steps(texts[a:b])]
                yield batch.iloc[a:b].assign(steps=steps).astype({"key": "Int64"})

    body = same_text(text)
    rows = docs.select(
        F.col(key).cast("long").alias("key"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.char_length(body).cast("long").alias("n_chars"),
        body.alias("text"),
    )
    rows = rows.mapInPandas(count, "key long, n_bytes long, n_chars long, steps binary")
    return rows.withColumnRenamed("key", key)


def counts(steps: bytes) -> np.ndarray:
    """Token count after 0, 1, 2, ... code points."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)])


@F.pandas_udf(LongType())
def token_count(steps: pd.Series) -> pd.Series:
    """Tokens of the whole text."""
    return steps.map(lambda s: int(np.frombuffer(s, np.int8).sum(dtype=np.int64)) if s is not None else None).astype("Int64")


@F.pandas_udf(LongType())
def tokens_before(steps: pd.Series, chars: pd.Series) -> pd.Series:
    """Tokens of the first ``chars`` code points (all, if there are no more; none for a negative number)."""
    found = [
        None if s is None or pd.isna(n) else int(np.frombuffer(s, np.int8)[: max(0, int(n))].sum(dtype=np.int64))
        for s, n in zip(steps, chars)
    ]
    return pd.Series(found, dtype="Int64")


@F.pandas_udf(LongType())
def chars_within(steps: pd.Series, budget: pd.Series) -> pd.Series:
    """Code points of the longest prefix with at most ``budget`` tokens; -1 for a negative budget."""
    found = []
    for s, n in zip(steps, budget):
        fit = None if s is None or pd.isna(n) else np.flatnonzero(counts(s) <= n)
        found.append(None if fit is None else int(fit[-1]) if len(fit) else -1)
    return pd.Series(found, dtype="Int64")


def truncate(docs: DataFrame, table: DataFrame, budget: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every text cut to its longest prefix of at most ``budget`` tokens; ``table`` has one row per key.

    Rows without a row in the table, such as those with a NULL key, go.
    """
    size = table.select(F.col(key), chars_within("steps", F.lit(budget)).alias("_chars"))
    joined = docs.join(size, key)
    cut: Column = F.substring(F.col(text), F.lit(1), F.col("_chars").cast("int"))
    return joined.select(*[cut.alias(c) if c == text else F.col(c) for c in docs.columns])
