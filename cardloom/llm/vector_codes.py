"""Product codes of vectors by Lloyd rounds in which members stay with the owner of their entry.

Every part of a vector is a member of one codebook entry.  Members lie in files dealt by (position, entry, salt).  A
round has the owners sum their members, sets the entries from the sums, and assigns each member where it lies.  Members
that keep their entry are written on beside their owner without a shuffle; only those that change it pass through
the next one.  All arithmetic is on integers, so results do not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.shared import new_folder, pieces_for, release, staged, staged_at

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
ROWS_PER_OWNER = 100_000
ROWS_PER_TASK = 400_000


@dataclass(frozen=True)
class Codebooks:
    """``entries[position][entry]`` are the integer components of an entry; fewer entries than asked for where there are fewer vectors."""

    entries: list[list[list[int]]]

    @property
    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position within the part."""
        return hashlib.sha256(",".join(str(x) for part in self.entries for e in part for x in e).encode()).hexdigest()

    def nearest(self, position: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row, the lower index if several are."""
        book = np.array(self.entries[position], np.int64).reshape(len(self.entries[position]), -1)
        index, far = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
        for i in range(0, len(x), 4096):
            gap = x[i : i + 4096, None, :] - book
            square = np.einsum("nkd,nkd->nk", gap, gap)
            index[i : i + 4096] = square.argmin(1)
            far[i : i + 4096] = square.min(1)
        return index, far


def bounds(dims: int, parts: int) -> list[int]:
    """Where parts begin and end: equal consecutive ones where ``parts`` divides ``dims``."""
    return [j * dims // parts for j in range(parts + 1)]


def largest(dims: int) -> int:
    """The largest size of a component for which a sum of ``dims`` squared differences fits 63 bits."""
    return 1 << ((62 - max(1, dims).bit_length()) // 2 - 1)


def integers(vectors: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, key, label, vec) of vectors with finite components only, in whole numbers, of the commonest dimension."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.where(v.isNotNull() & ~odd).select(
        F.monotonically_increasing_id().alias("id"),
        F.col(key).cast("long").alias("key"),
        F.col(label).cast("string").alias("label"),
        v.cast("array<double>").alias("vec"),
    )
    rows = staged(rows, "codes-vectors")
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dims = sizes["n"] if sizes else 0
    most = F.lit(float(largest(dims)))
    whole = F.transform("vec", lambda x: F.greatest(-most, F.least(most, F.floor(x * float(scale)).cast("double"))).cast("long"))
    return rows.where(F.size("vec") == dims).select("id", "key", "label", whole.alias("vec"))


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the smallest keys; equal keys by their components, NULL keys last."""
    first = rows.orderBy(F.asc_nulls_last("key"), "vec").limit(entries).collect()
    cut = bounds(len(first[0]["vec"]), parts) if first else [0] * (parts + 1)
    return Codebooks([[list(r["vec"][a:b]) for r in first] for a, b in zip(cut, cut[1:])])


MEMBER = "id long, key long, label string, position int, part array<long>, entry int"


def matrix(parts: pd.Series) -> np.ndarray:
    return np.array(parts.tolist(), np.int64).reshape(len(parts), -1)


def assigned(members: DataFrame, books: Codebooks) -> DataFrame:
    """Members with their nearest ``entry`` and its ``error``, and whether they ``moved``; no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            entry = np.empty(len(batch), np.int32)
            error = np.empty(len(batch), np.int64)
            for position, at in batch.groupby("position").indices.items():
                entry[at], error[at] = books.nearest(position, matrix(batch["part"].iloc[at]))
            moved = entry != batch["entry"].to_numpy()
            yield batch.assign(entry=entry, error=error, moved=moved).astype({"key": "Int64"})

    return members.mapInPandas(run, MEMBER + ", error long, moved boolean")


def summed(members: DataFrame) -> DataFrame:
    """(position, entry, i, total, n): sums and numbers of the members of each entry, by component."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for (position, entry), at in batch.groupby(["position", "entry"]).indices.items():
                total = matrix(batch["part"].iloc[at]).sum(0)
                out += [(position, entry, i, int(t), len(at)) for i, t in enumerate(total)]
            yield pd.DataFrame(out, columns=["position", "entry", "i", "total", "n"])

    sums = members.select("position", "entry", "part").mapInPandas(run, "position int, entry int, i int, total long, n long")
    whole = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    return sums.groupBy("position", "entry", "i").agg(whole, F.sum("n").alias("n"))


def updated(members: DataFrame, books: Codebooks) -> Codebooks:
    """Entries moved to the floor of the mean of their members; an entry without members stays.

    As many numbers as the codebooks have reach the driver.
    """
    entries = [[list(e) for e in part] for part in books.entries]
    for r in summed(members).collect():
        entries[r["position"]][r["entry"]][r["i"]] = int(r["total"]) // r["n"]
    return Codebooks(entries)


def dealt(members: DataFrame, tasks: int, salts: int) -> DataFrame:
    """Members brought to the owner of their entry; a heavy entry has ``salts`` owners."""
    salt = F.pmod(F.xxhash64("id"), F.lit(salts))
    return members.repartition(tasks, "position", "entry", salt)


@dataclass(frozen=True)
class Encoded:
    """``members`` (id, key, label, position, part, entry, error, ...) under the final ``books``."""

    members: DataFrame
    books: Codebooks


def lloyd(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Encoded:
    """Rounds over (id, key, label, vec) of equal dimension; the folder of a round goes when the next one is written."""
    spark = rows.sparkSession
    books = first_codebooks(rows, parts, entries)
    n = rows.count()
    tasks, salts = pieces_for(n * parts, ROWS_PER_TASK), pieces_for(n, ROWS_PER_OWNER)
    cut = bounds(sum(len(p[0]) for p in books.entries) if n else 0, parts)
    pieces = [F.struct(F.lit(j).alias("position"), F.slice("vec", a + 1, b - a).alias("part")) for j, (a, b) in enumerate(zip(cut, cut[1:]))]
    members = rows.select("id", "key", "label", F.explode(F.array(*pieces)).alias("p"))
    members = members.select("id", "key", "label", "p.*", F.lit(-1).alias("entry"))
    fields = [c.split()[0] for c in MEMBER.split(", ")]
    held, folder = dealt(assigned(members, books).select(*fields), tasks, salts), new_folder(spark, "codes-owners")
    held = staged_at(held, f"{folder}/arrived")
    for number in range(rounds):
        books = updated(held, books)
        if number == rounds - 1:
            break
        following = new_folder(spark, "codes-owners")
        assigned(held, books).select(*fields, "moved").write.partitionBy("moved").parquet(f"{following}/left")
        members = spark.read.schema(MEMBER + ", moved boolean").parquet(f"{following}/left")
        resident = members.where("not moved").select(*fields)
        arrived = staged_at(dealt(members.where("moved").select(*fields), tasks, salts), f"{following}/arrived")
        held = resident.unionAll(arrived)
        release(spark, folder)
        folder = following
    return Encoded(assigned(held, books), books)


def encode(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Per vector: key, code (two hex digits per part), error (squared distances), label_error and codebooks_sha256.

    Vectors that are NULL or hold NULL or non-finite components go, as do those of another dimension than the commonest
    (of equally common ones the larger).  Components become ``floor(scale * x)``, held within ``largest(dimension)``, which
    only components of many thousands reach.  Codebooks begin with the parts of the smallest keys.  Where ``parts`` does
    not divide the dimension, parts differ by one component.  Repeated rows and rows with a NULL key are vectors of their
    own.  Labels are summed as their text, NULL ones together.  An empty table gives no rows.
    """
    found = lloyd(integers(vectors, key, vector, label, scale), parts, entries, rounds)
    code = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "entry"))), lambda p: F.lpad(F.lower(F.hex(p["entry"])), 2, "0")), "")
    rows = found.members.groupBy("id", "key", "label").agg(code.alias("code"), F.sum("error").alias("error"))
    rows = staged(rows, "codes-rows")
    # One row per label, written: broadcast only if it is small, else joined with skewed labels split.
    name = F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))
    totals = staged(rows.groupBy(name.alias("_label")).agg(F.sum("error").alias("label_error")), "codes-labels")
    out = rows.withColumn("_label", name).join(totals, "_label")
    return out.select(F.col("key").alias(key), "code", "error", "label_error", F.lit(found.books.digest).alias("codebooks_sha256"))
