"""Packing of tokenised documents into windows by non-negative least squares.

Shallow combinations of piece lengths that fill a window exactly are the columns of a matrix, the
histogram of lengths is the right-hand side, and the non-negative solution says how often to use
each combination.  It is rounded down; what remains is packed greedily, and where no whole piece fits into the rest of
a window, one is cut.  All of this happens on
the histogram, which has at most as many entries as the window has tokens; documents stay
distributed and get their place from their number among the pieces of equal length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.remembered import RememberedHashes, codes, hashes, spans
from cardloom.llm.shared import blocks, gapless, pieces_for, same_text, spare_memory, staged

WINDOW = 2048
END_ID = 1
#: Pieces are cut at multiples of so many tokens only.
GRAIN = 16
MOST_WORDS = 250_000
#: Characters encoded side by side, and units sent to the tokenizer at once: a unit it answers takes some hundred bytes.
CHARS_AT_ONCE, UNITS_AT_ONCE = 1 << 18, 4_000
#: A tokenizer may be asked word by word if these texts come out alike.
_PROBES = ("The quick,brown  FOX\n\n jumps-over 12 dogs!? \u00c4rger \u00e9t\u00e9 na\u00efve", "don't we'll \u4f60\u597d \U0001f600 x", "a1b2..c", "")
#: What makes a text odd for the fast path (marks, scripts beyond Latin, a capital that becomes two
#: characters, apostrophes, which begin contractions, and control tokens), and Latin small letters.
_ODD = re.compile("[\u02b0-\U0010ffff\u0130']|<\\|")
_LETTERS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u012f\u0131-\u02af"
_WORD = re.compile(f"[{_LETTERS}]+")
#: By code: 0 for blanks, 1 for small letters, 2 for all else.
_KIND = np.full(0x110000, 2, np.uint8)
_KIND[[i for i in range(0x2B0) if _WORD.match(chr(i))]] = 1
_KIND[[ord(c) for c in " \t\r\n"]] = 0


def odd(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _ODD.search(text) is not None
    return "'" in text or "<|" in text


class WordEncoder:
    """Token ids of texts by a tokenizer that lower-cases and never joins pieces across white space or the end of a word.

    Every unit is encoded once and remembered by a 64-bit hash, about ``MOST_WORDS`` units in each of two generations.  Units are
    words and what stands between them, or, in texts that are odd, whatever stands between blanks.  A tokenizer that does
    not cut a probe text so is given whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.held = RememberedHashes(np.uint32, MOST_WORDS)
        whole = self.tokenizer.encode_batch(list(_PROBES), add_special_tokens=False)
        self.by_word = [e.ids for e in whole] == [x.tolist() for x in self.by_unit(list(_PROBES))]
        if not self.by_word:
            self.held = RememberedHashes(np.uint32, MOST_WORDS)

    def learn(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units and their numbers; words are sent many at once, and the tokens tell which word they are of."""
        words = [k for k, u in enumerate(units) if _WORD.fullmatch(u)]
        rest = np.setdiff1d(np.arange(len(units)), words).tolist()
        groups = [words[i : i + 400] for i in range(0, len(words), 400)]
        batch = self.tokenizer.encode_batch([" ".join([units[k] for k in g]) for g in groups], add_special_tokens=False)
        size = [np.bincount(e.word_ids, minlength=len(g)) for g, e in zip(groups, batch)]
        ids = [np.array(e.ids, np.uint32) for e in batch]
        batch = self.tokenizer.encode_batch([units[k] for k in rest], add_special_tokens=False)
        found = [e.ids for e in batch]
        size = np.concatenate([*size, np.fromiter(map(len, found), np.int64, len(found))]).astype(np.int64)
        ids = np.concatenate([*ids, np.fromiter(chain.from_iterable(found), np.uint32)])
        # They stand as sent, words first; put them in the order of the units.
        at = np.argsort(np.concatenate([words, rest]).astype(np.int64))
        return ids[spans((np.cumsum(size) - size)[at], size[at])], size[at]

    def learn_parts(self, text: str, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts of a text and their numbers, ``UNITS_AT_ONCE`` parts after the other."""
        found = []
        for i in range(0, len(start), UNITS_AT_ONCE):
            some = slice(i, i + UNITS_AT_ONCE)
            found.append(self.learn([text[a : a + n] for a, n in zip(start[some].tolist(), size[some].tolist())]))
        ids, count = zip(*found)
        return np.concatenate(ids), np.concatenate(count)

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and how many each has."""
        if not self.by_word:
            found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)
        strange = [odd(t) for t in texts]
        parts = [t if o else t.lower() for t, o in zip(texts, strange)]
        text, width = "".join(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(width)
        code = codes(text)
        kind = _KIND[code]
        for k in np.flatnonzero(strange).tolist():
            part = kind[ends[k] - width[k] : ends[k]]
            part[part > 0] = 2
        begins = kind > 0
        begins[1:] &= kind[1:] != kind[:-1]
        first = (ends - width)[width > 0]
        begins[first] = kind[first] > 0
        start = np.flatnonzero(begins)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        # A unit ends where the kind changes or the next text begins.
        change = np.ones(len(code) + 1, bool)
        change[1:-1] = kind[1:] != kind[:-1]
        change[first] = True
        bounds = np.flatnonzero(change)
        unit = np.diff(bounds)[kind[bounds[:-1]] > 0]
        hashed, index, which = np.unique(hashes(code, start, unit), return_index=True, return_inverse=True)
        shelf, spot = self.held.ensure(hashed, lambda new: self.learn_parts(text, start[index[new]], unit[index[new]]))
        ids, size = shelf.gather(spot[which])
        before = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, np.concatenate([[0], ends]))]
        return ids, np.diff(before)

    def by_unit(self, texts: list[str]) -> list[np.ndarray]:
        self.by_word = True
        ids, size = self.flat(texts)
        return np.split(ids, np.cumsum(size)[:-1])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for a, b in blocks(texts, CHARS_AT_ONCE):
            ids, size = self.flat(texts[a:b])
            yield from np.split(ids, np.cumsum(size)[:-1])


def token_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents cut into whole windows and a rest: (key, start, length, ids_crc32, doc_tokens, marks).

    The ids of a document are those of its text and ``END_ID``, so an empty or NULL text is one
    piece of one token.  ``ids_crc32`` is over little-endian unsigned 32-bit ids; ``marks`` are those of
    the piece's beginnings of ``GRAIN`` tokens, twice that, and so on.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = WordEncoder(tokenizer)
        for batch in batches:
            texts, keys = batch["text"].tolist(), batch["key"].astype("Int64")
            for a, b in blocks(texts, CHARS_AT_ONCE):
                ids, size = enc.flat(texts[a:b])
                size = size + 1
                with_end = np.full(int(size.sum()), END_ID, "<u4")
                inside = np.ones(len(with_end), bool)
                inside[np.cumsum(size) - 1] = False
                with_end[inside] = ids
                count = -(-size // window)
                owner = np.repeat(np.arange(len(size)), count)
                start = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * window
                length = np.minimum(size[owner] - start, window)
                at = 4 * ((np.cumsum(size) - size)[owner] + start)
                data = memoryview(with_end).cast("B")
                crc, marks = [], []
                for i, j in zip(at.tolist(), (at + 4 * length).tolist()):
                    sums = list(accumulate((data[k : min(j, k + 4 * GRAIN)] for k in range(i, j, 4 * GRAIN)), lambda c, part: zlib.crc32(part, c), initial=0))
                    crc.append(sums[-1])
                    marks.append(np.array(sums[1:-1], "<u4").tobytes())
                key = keys.iloc[a:b].iloc[owner].reset_index(drop=True)
                yield pd.DataFrame({"key": key, "start": start, "length": length, "ids_crc32": crc, "doc_tokens": size[owner], "marks": marks})
        # The encoder lives as long as its task.
        del enc
        spare_memory()

    rows = docs.select(F.col(key).cast("long").alias("key"), same_text(text).alias("text"))
    rows = rows.mapInPandas(cut, "key long, start long, length long, ids_crc32 long, doc_tokens long, marks binary")
    return rows.withColumnRenamed("key", key)


def combinations(lengths: np.ndarray, window: int, choices: int = 6) -> list[tuple[int, ...]]:
    """Combinations of up to four lengths, largest first, that fill the window exactly.

    For every length a few second and third lengths, evenly spread over those that fit, are
    completed by the one length that remains, if it exists.
    """
    have = set(lengths.tolist())
    found = {(window,)} if window in have else set()

    def spread(top: int) -> np.ndarray:
        fit = lengths[: np.searchsorted(lengths, top, "right")]
        return fit[np.unique(np.linspace(0, len(fit) - 1, choices).astype(int))] if len(fit) else fit

    def add(*parts: int) -> None:
        if parts[-1] in have:
            found.add(tuple(sorted(map(int, parts), reverse=True)))

    for a in lengths.tolist():
        left = window - a
        if left <= 0:
            continue
        add(a, left)
        for b in spread(left - 1).tolist():
            add(a, b, left - b)
            for c in spread(left - b - 1).tolist()[::2]:
                add(a, b, c, left - b - c)
    return sorted(found, reverse=True)


def nnls(columns: list[tuple[int, ...]], goal: np.ndarray, sweeps: int = 25) -> np.ndarray:
    """Least-squares repeat counts, none negative, by coordinate descent over the sparse columns."""
    left = goal.astype(float).tolist()
    counts = [0.0] * len(columns)
    shape = []
    for parts in columns:
        times = {p: parts.count(p) for p in parts}
        shape.append((list(times.items()), sum(t * t for t in times.values())))
    for _ in range(sweeps):
        moved = 0.0
        for j, (parts, norm) in enumerate(shape):
            step = 0.0
            for p, t in parts:
                step += t * left[p]
            step = max(-counts[j], step / norm)
            if step:
                counts[j] += step
                moved += abs(step)
                for p, t in parts:
                    left[p] -= t * step
        if moved < 0.5:
            break
    return np.array(counts)


class Place(NamedTuple):
    """Where a part of some pieces goes: the pieces of a length numbered from ``first`` on, ``count`` of them.

    The part is ``size`` tokens from token ``skip`` on; that of the i-th of these pieces stands in window ``base + i`` at ``offset``.
    """

    length: int
    skip: int
    first: int
    count: int
    size: int
    base: int
    offset: int


class Stock:
    """Unplaced pieces, or what is left of cut ones, by size; those of a size are taken in order."""

    def __init__(self, histogram: dict[int, int]):
        self.held: dict[int, list[list[int]]] = {}
        self.left: dict[int, int] = {}
        for length, n in histogram.items():
            if n:
                self.put(length, 0, 0, n, length)

    def put(self, length: int, skip: int, first: int, count: int, size: int) -> None:
        self.held.setdefault(size, []).append([length, skip, first, count])
        self.left[size] = self.left.get(size, 0) + count

    def take(self, size: int, count: int, used: int, base: int, offset: int) -> list[Place]:
        """``count`` pieces of ``size`` for windows from ``base`` on; of each the first ``used`` tokens, the rest goes back."""
        out = []
        self.left[size] -= count
        stacks = self.held[size]
        while count:
            length, skip, first, held = top = stacks[-1]
            n = min(held, count)
            out.append(Place(length, skip, first, n, used, base, offset))
            if n == held:
                stacks.pop()
            else:
                top[2], top[3] = first + n, held - n
            if used < size:
                self.put(length, skip + used, first, n, size - used)
            base, count = base + n, count - n
        if not self.left[size]:
            del self.left[size], self.held[size]
        return out


def greedy(left: dict[int, int], window: int, grain: int) -> tuple[list[tuple[int, int]], tuple[int, int] | None]:
    """The next window, largest sizes first: sizes with how many of each, and the size to cut with the tokens to take of it."""
    room, parts = window, []
    sizes = sorted(left, reverse=True)
    for size in sizes:
        if room < sizes[-1]:
            break
        if n := min(left[size], room // size):
            parts.append((size, n))
            room -= n * size
    spare = dict(left)
    for size, n in parts:
        spare[size] -= n
    cut = room // grain * grain
    longer = [size for size in sizes if spare[size] and size > cut] if cut else []
    return parts, (longer[0], cut) if longer else None


def plan(histogram: dict[int, int], window: int = WINDOW, grain: int = GRAIN) -> tuple[list[Place], int]:
    """Places for a histogram of piece lengths, and the number of windows.  Every token is placed exactly once.

    Pieces are cut at multiples of ``grain`` tokens, and only to fill what no whole piece fits.
    """
    stock, base, out = Stock(histogram), 0, []
    lengths = np.array(sorted(stock.left), np.int64)
    goal = np.zeros(window + 1, np.int64)
    for length, n in stock.left.items():
        goal[length] = n
    columns = combinations(lengths, window)
    for parts, count in zip(columns, np.floor(nnls(columns, goal) + 1e-9).astype(np.int64).tolist()):
        count = min(count, *(stock.left.get(p, 0) // parts.count(p) for p in parts))
        if count > 0:
            at = 0
            for p in parts:
                out += stock.take(p, count, p, base, at)
                at += p
            base += count
    while stock.left:
        parts, cut = greedy(stock.left, window, grain)
        need = dict(parts)
        if cut:
            need[cut[0]] = need.get(cut[0], 0) + 1
        count, at = min(stock.left[size] // n for size, n in need.items()), 0
        for size, n in parts:
            for _ in range(n):
                out += stock.take(size, count, size, base, at)
                at += size
        if cut:
            out += stock.take(cut[0], count, cut[1], base, at)
        base += count
    return out, base


class Lookup:
    """Places by (length, skip, number): for one length and skip no number is in two places."""

    def __init__(self, places: list[Place]):
        rows = sorted(places)
        table = np.array(rows, np.int64).reshape(-1, 7)
        self.first, self.size, self.base, self.offset = table[:, 2], table[:, 4], table[:, 5], table[:, 6]
        groups, start = np.unique(table[:, 0] * (1 << 20) + table[:, 1], return_index=True)
        self.bounds = dict(zip(groups.tolist(), zip(start.tolist(), [*start[1:].tolist(), len(table)])))

    def of(self, length: np.ndarray, skip: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Rows of the table."""
        code = length * (1 << 20) + skip
        out = np.empty(len(code), np.int64)
        order = np.argsort(code, kind="stable")
        groups, start = np.unique(code[order], return_index=True)
        for group, at in zip(groups.tolist(), np.split(order, start[1:])):
            a, b = self.bounds[group]
            out[at] = a + np.searchsorted(self.first[a:b], number[at], "right") - 1
        return out


# Fixed value: the polynomial of CRC-32, bits reversed.
_POLYNOMIAL = 0xEDB88320


def multiplied(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials modulo that of CRC-32, highest power in the lowest bit."""
    a, b, out = a.astype(np.uint64), b.astype(np.uint64), np.zeros(len(a), np.uint64)
    one = np.uint64(1)
    for bit in range(31, -1, -1):
        out ^= b * ((a >> np.uint64(bit)) & one)
        b = (b >> one) ^ (np.uint64(_POLYNOMIAL) * (b & one))
    return out


@lru_cache(2)
def shifts(tokens: int) -> np.ndarray:
    """For 0, 1, ... ``tokens`` ids of four bytes, the power by which they move what stands before them."""
    step = np.array([1 << 31], np.uint64)
    for _ in range(32):
        step = (step >> np.uint64(1)) ^ (np.uint64(_POLYNOMIAL) * (step & np.uint64(1)))
    out = np.zeros(tokens + 1, np.uint64)
    out[0] = 1 << 31
    for i in range(tokens):
        out[i + 1] = multiplied(out[i : i + 1], step)[0]
    return out


def crc_between(before: np.ndarray, upto: np.ndarray, tokens: np.ndarray, window: int) -> np.ndarray:
    """CRC-32 of ``tokens`` ids, from those of all that stands before them and of that with them."""
    return upto.astype(np.uint64) ^ multiplied(shifts(window)[tokens], before)


def place_parts(batch: pd.DataFrame, lookup: Lookup, window: int, grain: int) -> pd.DataFrame:
    """The parts of numbered pieces with their windows; a cut piece gives several rows."""
    length, number = batch["length"].to_numpy(np.int64), batch["number"].to_numpy(np.int64)
    skip, at, found = np.zeros(len(batch), np.int64), np.arange(len(batch)), []
    while len(at):
        k = lookup.of(length[at], skip, number[at])
        found.append((at, skip, lookup.size[k], lookup.base[k] + number[at] - lookup.first[k], lookup.offset[k]))
        skip = skip + lookup.size[k]
        on = skip < length[at]
        at, skip = at[on], skip[on]
    at, skip, size, window_id, offset = (np.concatenate(c) for c in zip(*found)) if found else [np.zeros(0, np.int64)] * 5
    whole = batch["ids_crc32"].to_numpy(np.uint64)
    crc = whole[at]
    cut = np.flatnonzero(size < length[at])
    if len(cut):
        marks = [np.frombuffer(batch["marks"].iat[i], "<u4") for i in at[cut].tolist()]
        upto = np.array([m[(a + n) // grain - 1] if a + n < w else 0 for m, a, n, w in zip(marks, skip[cut], size[cut], length[at[cut]])], np.uint64)
        upto = np.where(skip[cut] + size[cut] < length[at[cut]], upto, whole[at[cut]])
        before = np.array([m[a // grain - 1] if a else 0 for m, a in zip(marks, skip[cut])], np.uint64)
        crc[cut] = np.where(skip[cut] > 0, crc_between(before, upto, size[cut], window), upto)
    out = batch[["key", "doc_tokens"]].iloc[at].reset_index(drop=True)
    start = batch["start"].to_numpy(np.int64)[at] + skip
    return out.assign(start=start, length=size, ids_crc32=crc.astype(np.int64), sequence_id=window_id, offset=offset).astype({"key": "Int64"})


def pack(pieces: DataFrame, window: int = WINDOW, key: str = "doc_id") -> DataFrame:
    """Pieces, cut where it saves padding, with ``sequence_id`` and ``offset``.

    Pieces of equal length are interchangeable, so their number within the length decides. The table
    of places depends on the lengths alone: some thousand rows, however many pieces there are.
    Repeated rows get places of their own; no pieces give no rows.
    """
    pieces = staged(pieces, "packing-pieces")
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = {r["length"]: r["n"] for r in counts}
    lookup = Lookup(plan(histogram, window)[0])
    order = [key, "start", "ids_crc32", "doc_tokens"]
    numbered = gapless(pieces, ["length"], order, "number", pieces_for(sum(histogram.values())))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield place_parts(batch, lookup, window, GRAIN)
        spare_memory()

    rows = numbered.withColumnRenamed(key, "key")
    rows = rows.mapInPandas(place, "key long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return rows.withColumnRenamed("key", key)


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents to placed pieces; see :func:`token_pieces` and :func:`pack`.

    Columns of ``docs`` other than key and text do not matter; NULL keys stay NULL.
    """
    return pack(token_pieces(docs, tokenizer, window, key, text), window, key)
