"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector, less the mean of its group, to the signs of random projections, read as one number, and
sorts by it: vectors at a small angle tend to stand near each other.  Within the order each vector is compared with a
bounded window of followers, by a signature of 128 further signs; vectors themselves do not travel with the passes.  The number of
passes of a group follows from a trial pass over all of its vectors, for a stated recall.  What the passes of all kinds bring together is then
compared exactly, in blocks, and the verified links are united.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.shared import chunk_pairs, components, local_components, pieces_for, staged

COSINE = 0.93
#: The expected share of pairs just at the cosine that the passes of a group find.
RECALL = 0.999
NEIGHBOURS = 1024
BITS = 40
SIGNATURE = 128
#: How far beyond the expected number of differing signs, in standard deviations, a pair is still looked at.
SLACK = 4.5
ROWS_PER_TASK = 2_000
MOST_PER_CHUNK = 20_000
#: Groups that would need more passes are compared in full.
MOST_PASSES = 96
#: Steps in which the chance of a differing sign is counted.
STEPS = 512


@lru_cache(8)
def projections(dims: int, passes: int, bits: int, seed: int = 11) -> np.ndarray:
    """(dims, passes * bits) directions, the same on every machine."""
    return np.random.default_rng([seed, dims]).normal(size=(dims, passes * bits))


def codes(x: np.ndarray, passes: int, bits: int) -> np.ndarray:
    """(rows, passes) numbers whose order is the lexicographic order of the sign bits."""
    signs = (x @ projections(x.shape[1], passes, bits) > 0).reshape(len(x), passes, bits)
    return signs @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


def signatures(x: np.ndarray) -> np.ndarray:
    """(rows, SIGNATURE / 8) bytes: further signs, by directions of their own."""
    return np.packbits(x @ projections(x.shape[1], 1, SIGNATURE, 12) > 0, axis=1)


def units(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    # Scaled by the largest component first, so that no square over- or underflows.
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def agreement(square: np.ndarray, cosine: float) -> np.ndarray:
    """The chance that a sign agrees in two vectors at ``cosine``, from their squared distance to the mean: the angle there over pi."""
    return 1 - np.arccos(np.clip(1 - (1 - cosine) / np.maximum(square, 1e-300), -1, 1)) / np.pi


def most_differing(apart: float) -> int:
    """The most signs in which a pair may differ, from the chance that one differs."""
    return min(SIGNATURE, int(np.ceil(SIGNATURE * apart + SLACK * np.sqrt(SIGNATURE * apart * (1 - apart)))))


def depths(code: np.ndarray, signs: np.ndarray, linked: np.ndarray, reach: int) -> np.ndarray:
    """For sorted codes the bits in which no vector beyond ``reach`` places agrees, linked ones aside.

    A vector beyond that differs in at most ``linked`` signs counts as linked: the window is full of linked ones then.
    """
    deep = np.zeros(len(code), np.int64)
    n = len(code) - reach - 1
    if n > 0:
        shared = BITS - np.frexp((code[:n] ^ code[-n:]).astype(np.float64))[1]
        apart = np.bitwise_count(signs[:n] ^ signs[-n:]).sum(1)
        deep[:n] = np.where(apart > linked[:n], shared + 1, 0)
        deep[-n:] = np.maximum(deep[-n:], np.where(apart > linked[-n:], shared + 1, 0))
    return np.minimum(deep, BITS)


def centres(rows: DataFrame) -> DataFrame:
    """(group, centre): the mean of all unit vectors of each group, for rows (group, vec)."""
    sums = "group string, n long, sums array<double>"

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        for batch in batches:
            for group, part in batch.groupby("group"):
                own = held.setdefault(group, [0, 0.0])
                own[0] += len(part)
                own[1] = own[1] + units(part["vec"]).sum(0)
        yield pd.DataFrame({"group": list(held), "n": [n for n, _ in held.values()], "sums": [x for _, x in held.values()]})

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        # Rounded, so that the order of the parts does not matter.
        centre = np.round(np.sum(np.stack(pdf["sums"]), 0) / pdf["n"].sum(), 9)
        return pd.DataFrame({"group": pdf["group"].iloc[:1], "centre": [centre]})

    return rows.select("group", "vec").mapInPandas(add, sums).groupBy("group").applyInPandas(mean, "group string, centre array<double>")


def planned(reps: DataFrame, cosine: float, neighbours: int, recall: float) -> DataFrame:
    """(group, n, passes, differ, centre) of all groups; passes is NULL where a group is compared in full.

    A group that fits into one window has one pass, in which all of it is looked at.  All vectors of a larger one are sorted in a
    trial pass: each has a number of bits after which those that agree in all of them, linked ones aside, fill
    half a window, and so a chance that a neighbour at the cosine agrees in these too.  The passes make the mean chance of
    all vectors at least ``recall``; ``differ`` holds for 99 of 100 vectors.
    """
    sizes = staged(reps.groupBy("group").agg(F.count(F.lit(1)).alias("n")), "vectors-sizes")
    small, most, reach = F.col("n") <= neighbours, MOST_PASSES, neighbours // 4
    large = sizes.where(~small).select("group")
    rows = reps.join(large, "group")
    middle = staged(centres(rows), "vectors-centres")
    found = {"seen": "long", "missed": "array<double>", "steps": "array<long>"}
    fields = ", ".join(f"{k} {v}" for k, v in found.items())

    def trial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group, part in batch.groupby("group"):
                x = units(part["vec"]) - np.asarray(part["centre"].iat[0])
                signs = signatures(x).view(np.int64)
                yield pd.DataFrame({"group": group, "code": codes(x, 1, BITS)[:, 0], "s0": signs[:, 0], "s1": signs[:, 1], "square": (x * x).sum(1)})

    def tallied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        waiting, before = None, 0

        def take(part: pd.DataFrame, known: int, upto: int) -> None:
            """Count the rows from ``known`` to ``upto`` of rows of one group."""
            close = agreement(part["square"].to_numpy(), cosine)
            signs = part[["s0", "s1"]].to_numpy().view(np.uint64)
            deep = depths(part["code"].to_numpy(), signs, np.where(close > 0.6, SIGNATURE * (1 - close), -1), reach)[known:upto]
            close = close[known:upto]
            own = held.setdefault(part["group"].iat[0], [0, np.zeros(most), np.zeros(STEPS + 1, np.int64)])
            own[0] += upto - known
            missed = 1 - close**deep
            left = missed.copy()
            for p in range(most):
                own[1][p] += left.sum()
                left *= missed
            own[2] += np.bincount(np.ceil((1 - close) * STEPS).astype(np.int64), minlength=STEPS + 1)

        for batch in batches:
            if batch.empty:
                continue
            whole = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
            group = whole["group"].to_numpy()
            edges = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(whole)]
            for first, end in zip(edges[:-2], edges[1:-1]):
                take(whole.iloc[first:end], before, end - first)
                before = 0
            # The last rows of what is here wait for their followers; those before them are kept for these.
            last = whole.iloc[edges[-2] :]
            upto = max(before, len(last) - reach - 1)
            if upto > before:
                take(last, before, upto)
            start = max(0, upto - reach - 1)
            waiting, before = last.iloc[start:], upto - start
        if waiting is not None and before < len(waiting):
            take(waiting, before, len(waiting))
        names = list(held)
        yield pd.DataFrame({"group": names} | {k: [held[g][i] for g in names] for i, k in enumerate(found)})

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        seen, missed = pdf["seen"].sum(), np.sum(np.stack(pdf["missed"]), 0)
        enough = np.flatnonzero(np.round(missed / seen, 9) <= 1 - recall)
        steps = np.cumsum(np.sum(np.stack(pdf["steps"]), 0))
        apart = int(np.searchsorted(steps, 0.99 * seen)) / STEPS
        passes = pd.array([int(enough[0]) + 1 if len(enough) else None], "Int32")
        return pd.DataFrame({"group": pdf["group"].iloc[:1], "passes": passes, "differ": [most_differing(apart)]})

    hashed = rows.join(middle, "group").select("group", "vec", "centre").mapInPandas(trial, "group string, code long, s0 long, s1 long, square double")
    tasks = pieces_for(int(sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]), 200_000)
    tallies = hashed.repartitionByRange(max(tasks, 8), "group", "code", "s0").sortWithinPartitions("group", "code", "s0", "s1").mapInPandas(tallied, f"group string, {fields}")
    plans = tallies.groupBy("group").applyInPandas(plan, "group string, passes int, differ int").join(middle, "group")
    return staged(
        sizes.join(plans, "group", "left").select(
            "group",
            "n",
            F.when(small, 1).otherwise(F.col("passes")).alias("passes"),
            F.when(small, SIGNATURE).otherwise(F.col("differ")).alias("differ"),
            "centre",
        ),
        "vectors-plans",
    )


def candidates(reps: DataFrame, cosine: float, neighbours: int, recall: float) -> DataFrame:
    """Edges (a, b) that connect what may be linked, for rows (id, group, vec)."""
    plans = planned(reps, cosine, neighbours, recall)
    found = sorted_passes(reps.join(plans.where("passes is not null"), "group"), neighbours)
    whole = plans.where("passes is null").select("group")
    if whole.isEmpty():
        return found.distinct()
    # All of such a group is compared, whatever may be linked in it: its rows are tied to the smallest one.
    rest = reps.join(whole, "group").select("group", "id")
    ends = rest.groupBy("group").agg(F.min("id").alias("b"))
    return found.union(rest.join(ends, "group").select(F.col("id").alias("a"), "b")).distinct()


def sorted_passes(reps: DataFrame, neighbours: int) -> DataFrame:
    """Edges (a, b) that connect what the windows of all passes hold together, for rows (id, group, vec, n, passes, differ, centre).

    Rows of a pass are dealt to tasks by ranges of (pass and group, code): five numbers, not vectors.  Windows end
    at the border of a task; the borders of the passes are independent, and a group of one pass has one code, so that no
    border cuts it.
    """

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group, part in batch.groupby("group"):
                passes, ids = int(part["passes"].iat[0]), part["id"].to_numpy()
                whole = int(part["n"].iat[0]) <= neighbours
                x = units(part["vec"])
                if part["centre"].iat[0] is not None:
                    x = x - np.asarray(part["centre"].iat[0])
                # Below the code, 15 bits of the id part equal codes, and 8 carry the most signs in which a pair may differ.
                c = np.zeros((len(x), 1), np.int64) if whole else codes(x, passes, BITS) << 15 | (ids * 0x9E3779B1 >> 7 & 0x7FFF)[:, None]
                c = c << 8 | int(part["differ"].iat[0])
                signs = signatures(x).view(np.int64)
                for p in range(passes):
                    run = int.from_bytes(blake2b(f"{p}:{group}".encode(), digest_size=8).digest(), "big", signed=True)
                    yield pd.DataFrame({"run": run, "code": c[:, p], "id": ids, "s0": signs[:, 0], "s1": signs[:, 1]})

    fields = "run long, code long, id long, s0 long, s1 long"
    rows = reps.select("id", "group", "vec", "n", "passes", "differ", "centre").mapInPandas(hashed, fields)
    tasks = pieces_for(int(reps.agg(F.coalesce(F.sum("passes"), F.lit(0))).first()[0]), 200_000)
    rows = rows.repartitionByRange(max(tasks, 8), "run", "code").sortWithinPartitions("run", "code", "id")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried = None
        for batch in batches:
            if batch.empty:
                continue
            whole = batch if carried is None else pd.concat([carried, batch], ignore_index=True)
            run, ids = whole["run"].to_numpy(), whole["id"].to_numpy()
            bits = whole[["s0", "s1"]].to_numpy().view(np.uint64)
            differ = whole["code"].to_numpy() & 0xFF
            starts = np.flatnonzero(np.diff(run, prepend=run[0] - 1))
            left, right = [], []
            for first, end in zip(starts.tolist(), [*starts[1:].tolist(), len(run)]):
                for i in range(first, end, neighbours):
                    near, other = bits[i : min(end, i + neighbours)], bits[i : min(end, i + 2 * neighbours)]
                    apart = sum(np.bitwise_count(near[:, None, k] ^ other[:, k]).astype(np.int16) for k in range(bits.shape[1]))
                    a, b = np.nonzero(apart <= differ[first])
                    ok = (b > a) & (b <= a + neighbours)
                    left.append(i + a[ok])
                    right.append(i + b[ok])
            i, j = np.concatenate(left), np.concatenate(right)
            root = local_components(len(whole), i, j)
            some = np.unique(np.concatenate([i, j]))
            low = pd.Series(ids[some]).groupby(root[some]).transform("min").to_numpy() if len(some) else ids[:0]
            yield pd.DataFrame({"a": ids[some], "b": low})
            carried = whole.tail(neighbours)

    return rows.mapInPandas(compare, "a long, b long")


def verified(reps: DataFrame, groups: DataFrame, cosine: float) -> DataFrame:
    """(id, root, links) from each task that holds a linked vector, for rows (id, group, copies, vec) and their component.

    All vectors of a component and group are compared.  ``links`` adds up the copies of the vectors within the cosine; the edges
    (id, root) connect what is linked.
    """
    held = reps.join(groups, "id").withColumn("_one", F.lit(1))
    largest = int(groups.groupBy("component").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0])
    dealt = chunk_pairs(held, "component", "id", "_one", min(MOST_PER_CHUNK, max(ROWS_PER_TASK, largest // 8)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        links, root = np.zeros(len(pdf)), np.arange(len(pdf))
        copies, ids = pdf["copies"].to_numpy(), pdf["id"].to_numpy()
        low, high, chunk = int(pdf["_low"].iat[0]), int(pdf["_high"].iat[0]), pdf["_chunk"].to_numpy()
        for at in pdf.groupby(["component", "group"]).indices.values():
            x = units(pdf["vec"].iloc[at])
            left = np.flatnonzero(chunk[at] == low)
            for i in range(0, len(left), 256):
                part = left[i : i + 256]
                other = np.arange(len(at)) if low == high else np.flatnonzero(chunk[at] == high)
                near = x[part] @ x[other].T >= cosine
                if low == high:
                    near[np.arange(len(part)), part] = False
                else:
                    links[at[other]] += copies[at[part]] @ near
                links[at[part]] += near @ copies[at[other]]
                a, b = np.nonzero(near)
                a, b = root[at[part[a]]], root[at[other[b]]]
                if (a != b).any():
                    root = local_components(len(root), a[a != b], b[a != b])[root]
        some = links > 0
        lowest = pd.Series(ids).groupby(root).transform("min").to_numpy()
        return pd.DataFrame({"id": ids[some], "root": lowest[some], "links": links[some].astype(np.int64)})

    fields = ["_task", "_low", "_high", "_chunk", "id", "group", "component", "copies", "vec"]
    return dealt.select(*fields).groupBy("_task").applyInPandas(run, "id long, root long, links long")


def dedup(
    vectors: DataFrame,
    cosine: float = COSINE,
    recall: float = RECALL,
    neighbours: int = NEIGHBOURS,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Per vector: key, n_links, component_id (smallest key reachable by links) and kept.

    Only vectors with equal labels and dimensions are compared. Equal vectors are one class, linked without a
    search.  A group of more vectors than a window is searched by passes for the expected ``recall``, or in full if it
    would take more than ``MOST_PASSES``.  Vectors that are NULL, empty, zero or hold NULL or non-finite components, rows without a
    label, and rows with a NULL key link with nothing; they are kept, with themselves as component.
    Repeated rows count as vectors.
    """
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = F.col(label).isNotNull() & F.col(key).isNotNull() & (F.size(v) > 0) & ~odd & F.exists(v, lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    wide = v.cast("array<double>")
    group = F.concat_ws("/", F.col(label).cast("string"), F.size(v))
    name = F.when(usable, F.concat_ws("/", group, F.xxhash64(wide), F.xxhash64(F.lit(1), wide)))
    rows = vectors.select(F.col(key).cast("long").alias("id"), name.alias("class"), group.alias("group"), v.alias("vec"))
    classes = rows.where("class is not null").groupBy("class").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    # Classes are numbered: one key may stand on different vectors.
    classes = staged(classes.select("class", "id", "copies", F.monotonically_increasing_id().alias("node")), "vectors-classes")
    reps = rows.where("class is not null").join(classes, ["class", "id"]).dropDuplicates(["class"])
    reps = staged(reps.select(F.col("node").alias("id"), "class", "group", "copies", "vec"), "vectors-reps")
    near = components(candidates(reps.select("id", "group", "vec"), cosine, neighbours, recall)).withColumnRenamed("node", "id")
    found = staged(verified(reps.select("id", "group", "copies", "vec"), near, cosine), "vectors-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    members = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    lowest = members.join(classes, "node").groupBy("component").agg(F.min("id").alias("lowest"))
    members = members.join(lowest, "component").select("node", "lowest")
    named = classes.join(members, "node", "left").join(links.withColumnRenamed("id", "node"), "node", "left")
    named = staged(
        named.select("class", F.coalesce("lowest", "id").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")),
        "vectors-named",
    )
    out = rows.select("id", "class").join(named, "class", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
