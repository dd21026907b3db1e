"""Exact self join of documents by the Jaccard likeness of their word n-grams, by T-occurrence search.

Two sets with likeness of at least ``t`` share many elements, so a document whose shingles
are mostly its own has no partner.  That is seen from one aggregate over the lowest-hashed part
of all sets.  The sets that remain are brought together by the rarest of their shared
shingles, and within such blocks a DivideSkip search runs over inverted lists: the short
lists are merged, the long ones probed by binary search, and documents that reach the required
overlap are kept.  No pairs of documents leave a task, only links per document and a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.shared import chunk_pairs, components, local_components, same_text, spare_memory, staged

WORDS = 4
LIKENESS = Fraction(85, 100)
#: The share of each set, lowest hashes first, that is counted over all documents; short sets count whole.
SHARE = Fraction(3, 10)
SHORT = 32
TASK_SHINGLES = 1_000_000
#: DivideSkip's weight of a probe against a merge step.
PROBE = 0.0085

_K = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTE = np.random.default_rng(17).integers(0, 1 << 64, 256, np.uint64)


def spread_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_INVERSE = pow(int(_K), -1, 1 << 64)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and where each text's words begin and end.

    Words are runs of other than blank and white-space control characters; A-Z are lower-cased.  A word's
    hash is a polynomial in its bytes, taken from running sums over the bytes of all texts.
    """
    data = [(t or "").encode("utf-8", "replace") for t in texts]
    joined = np.frombuffer(b" ".join([*data, b""]).lower(), np.uint8)
    ends = np.cumsum([len(d) + 1 for d in data])
    blank = _BLANK[joined]
    edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    start, end = edge[::2], edge[1::2]
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_BYTE[joined] * powers(int(_K), len(joined)), out=sums[1:])
    back = powers(_INVERSE, len(joined) + 1)
    hashes = spread_bits((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
    return hashes, np.concatenate([[0], np.searchsorted(start, ends)])


def shingles(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    Of fewer words the whole sequence is one; there is none without words.
    """
    h, bounds = word_hashes(texts)

    def polynomial(part: np.ndarray, width: int) -> np.ndarray:
        s = part[: len(part) - width + 1].copy()
        for k in range(1, width):
            s = s * _K + part[k : len(part) - width + 1 + k]
        return spread_bits(s + np.uint64(width))

    runs = polynomial(h, words) if len(h) >= words else h[:0]
    out = []
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        n = j - i
        out.append(np.unique(runs[i : j - words + 1]) if n >= words else polynomial(h[i:j], n) if n else h[:0])
    return out


def least_overlap(n: int, likeness: Fraction) -> int:
    """The smallest overlap of a set of ``n`` with any partner."""
    return ceil(likeness * n)


def counted(n: int) -> int:
    """How many of the lowest hashes of a set are counted over all documents."""
    return n if n <= SHORT else max(SHORT, ceil(SHARE * n))


def least_shared(n: int, likeness: Fraction) -> int:
    """The smallest number of counted shingles that a set of ``n`` shares with a partner's counted ones.

    All common shingles below the lower of the two cuts are counted in both. If that cut is the set's own,
    at most ``n - overlap`` of those below it are not common; if it is the partner's, the same holds
    for the partner, whose size lies between ``t * n`` and ``n / t``.
    """
    own = counted(n) - (n - least_overlap(n, likeness))
    half = likeness / (1 + likeness)
    other = min(half * n + (SHARE + half - 1) * size for size in (likeness * n, n / likeness))
    return max(1, min(own, int(other)))


def sets_of(docs: DataFrame, words: int, likeness: Fraction, whole: bool) -> DataFrame:
    """(doc, text) to (doc, n, counted, least, class, shingles): the set's size, its class, and its counted or all shingles."""
    schema = "doc long, n long, counted long, least long, class string, shingles array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_hexdigest

        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                found = shingles(part.column(1).to_pylist(), words)
                n = [len(s) for s in found]
                names = [xxh3_128_hexdigest(s.tobytes()) for s in found]
                kept = found if whole else [s[: counted(len(s))] for s in found]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in kept])]).astype(np.int32)
                flat = np.concatenate([*kept, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n, pa.int64()),
                        pa.array([counted(k) for k in n], pa.int64()),
                        pa.array([least_shared(k, likeness) if k else 0 for k in n], pa.int64()),
                        pa.array(names, pa.string()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    ],
                    ["doc", "n", "counted", "least", "class", "shingles"],
                )
        spare_memory()

    return docs.mapInArrow(run, schema)


def divide_skip(sets: list[np.ndarray], queries: np.ndarray, index: np.ndarray, likeness: Fraction, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, indexed) of positions in ``sets`` with at least the likeness.

    ``both``: queries and index are the same sets, and every pair is returned once.
    """
    num, den = likeness.numerator, likeness.denominator
    size = np.array([len(s) for s in sets], np.int64)
    index = index[np.argsort(size[index], kind="stable")]
    of_index = size[index]
    place = np.full(len(sets), -1)
    place[index] = np.arange(len(index))
    flat = np.concatenate([sets[i] for i in index]) if len(index) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(index)), of_index)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    keys, first = np.unique(flat, return_index=True)
    length = np.diff(np.append(first, len(flat)))
    left, right = [], []
    for q in queries.tolist():
        n, need = int(size[q]), least_overlap(int(size[q]), likeness)
        at = np.minimum(np.searchsorted(keys, sets[q]), max(len(keys) - 1, 0))
        at = at[keys[at] == sets[q]] if len(keys) else at[:0]
        if both:
            at = at[length[at] > 1]
        if len(at) < need or not need:
            continue
        at = at[np.argsort(length[at], kind="stable")]
        most = int(length[at[-1]])
        long = min(need - 1, int(need / (PROBE * np.log2(most + 1) + 1)))
        short = len(at) - long
        # The merge of the short lists: sorted runs, and how often each document stands in them.
        runs = np.concatenate([owner[first[k] : first[k] + length[k]] for k in at[:short]])
        found, count = np.unique(runs, return_counts=True)
        ok = (count >= need - long) & (of_index[found] * den >= n * num) & (of_index[found] * num <= n * den)
        if both:
            ok &= found > place[q]
        found, count = found[ok], count[ok]
        for done, k in enumerate(at[short:]):
            if not len(found):
                break
            probe = owner[first[k] : first[k] + length[k]]
            spot = np.minimum(np.searchsorted(probe, found), len(probe) - 1)
            count = count + (probe[spot] == found)
            ok = count + (long - done - 1) >= need
            found, count = found[ok], count[ok]
        ok = den * count >= num * (n + of_index[found] - count)
        left.append(np.full(int(ok.sum()), q))
        right.append(index[found[ok]])
    none = np.zeros(0, np.int64)
    return np.concatenate([*left, none]).astype(np.int64), np.concatenate([*right, none]).astype(np.int64)


def blocks(sets: DataFrame, likeness: Fraction) -> DataFrame:
    """(node, component) over documents (doc, n, shingles): linked documents always share a component.

    Of the shingles that a set shares with others, the rarest ``shared - overlap + 1`` must hold a common one.
    """
    num, den = likeness.numerator, likeness.denominator
    rows = sets.select("doc", "n", F.explode("shingles").alias("s"))
    often = rows.groupBy("s").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = rows.join(often, "s").groupBy("doc").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("often", "s"))).alias("list"))
    overlap = F.expr(f"cast((n * {num} + {den - 1}) div {den} as int)")
    shared = shared.where(F.size("list") >= overlap)
    first = F.slice("list", F.lit(1), F.size("list") - overlap + 1)
    lists = staged(shared.select("doc", F.explode(first).alias("e")).select("doc", "e.s"), "join-lists")
    heads = lists.groupBy("s").agg(F.min("doc").alias("head"))
    return components(lists.join(heads, "s").select(F.col("doc").alias("a"), F.col("head").alias("b")))


def search(sets: DataFrame, likeness: Fraction) -> DataFrame:
    """(doc, root, links) for documents (doc, n, copies, shingles) that have a link, from each task that holds one.

    ``links`` adds up the copies of the linked sets; the edges (doc, root) connect what is linked.
    """
    held = sets.join(blocks(sets, likeness).withColumnRenamed("node", "doc").withColumnRenamed("component", "block"), "doc")
    dealt = chunk_pairs(held, "block", "doc", "n", TASK_SHINGLES)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc")
        doc, copies = pdf["doc"].to_numpy(), pdf["copies"].to_numpy()
        low, high, chunk = (int(pdf["_low"].iat[0]), int(pdf["_high"].iat[0]), pdf["_chunk"].to_numpy())
        sets = [np.asarray(s) for s in pdf["shingles"]]
        every = np.arange(len(pdf))
        if low == high:
            i, j = divide_skip(sets, every, every, likeness, True)
        else:
            i, j = divide_skip(sets, every[chunk == low], every[chunk == high], likeness, False)
        links = np.bincount(i, copies[j], len(pdf)) + np.bincount(j, copies[i], len(pdf))
        root = local_components(len(pdf), i, j)
        some = links > 0
        return pd.DataFrame({"doc": doc[some], "root": doc[root[some]], "links": links[some].astype(np.int64)})

    fields = ["_task", "_low", "_high", "_chunk", "doc", "copies", "shingles"]
    return dealt.select(*fields).groupBy("_task").applyInPandas(run, "doc long, root long, links long")


def join(docs: DataFrame, likeness: Fraction = LIKENESS, words: int = WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_shingles, component_id (smallest key reachable by links) and n_links.

    Documents link when intersection / union of their sets is at least ``likeness``, exactly. Documents with
    equal sets are one class and link with each other; only classes are searched. NULL and empty
    texts have an empty set and link with nothing; rows with a NULL key link with nothing and have no
    component. Repeated rows count as documents. Other columns of ``docs`` do not matter.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc"), same_text(text).alias("text"))
    counts = staged(sets_of(rows, words, likeness, False), "join-counted")
    linked = counts.where("n > 0 and doc is not null")
    classes = linked.groupBy("class").agg(
        F.min("doc").alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("n").alias("n"), F.any_value("least").alias("least"), F.any_value("counted").alias("counted")
    )
    # Half of the class's name is enough to tell whether two classes hold a shingle.
    half = F.conv(F.substring("class", 1, 15), 16, 10).cast("long")
    held = linked.select(half.alias("c"), F.explode("shingles").alias("s")).groupBy("s").agg(F.min("c").alias("c"), F.max("c").alias("d"))
    own = held.where("c = d").groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    classes = classes.withColumn("c", half).join(own, "c", "left")
    is_open = F.col("counted") - F.coalesce("own", F.lit(0)) >= F.col("least")
    # Classes are numbered: one key may stand on rows of different texts.
    numbered = classes.select("class", "first", "copies", is_open.alias("open"), F.monotonically_increasing_id().alias("node"))
    classes = staged(numbered, "join-classes")
    wanted = classes.where("open").select(F.col("first").alias("doc"), F.col("class").alias("_class"), "copies", "node")
    again = rows.join(wanted.select("doc").distinct(), "doc", "left_semi")
    sets = sets_of(again, words, likeness, True).join(wanted, "doc").where("class = _class").dropDuplicates(["class"])
    sets = staged(sets.select(F.col("node").alias("doc"), "n", "copies", "shingles"), "join-sets")
    found = staged(search(sets, likeness), "join-links")
    groups = components(found.select(F.col("doc").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("doc").agg(F.sum("links").alias("links"))
    lowest = groups.join(classes, "node").groupBy("component").agg(F.min("first").alias("lowest"))
    groups = groups.join(lowest, "component").select("node", "lowest")
    named = classes.join(groups, "node", "left").join(links.withColumnRenamed("doc", "node"), "node", "left")
    named = staged(
        named.select("class", F.coalesce("lowest", "first").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")),
        "join-named",
    )
    out = counts.select("doc", "n", F.when(F.col("doc").isNotNull(), F.col("class")).alias("class")).join(named, "class", "left")
    return out.select(
        F.col("doc").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )
