"""How filters act on each other in every order, from one streaming pass over the files of a table.

Files are taken as available-now micro-batches.  Each document becomes a mask of the filters it fails.  Whether its
text stands at a smaller id is known only from state keyed by text: the smallest id so far and the documents there.  A
document with a larger id is a copy at once.  When a smaller id arrives, the masks counted for the former one are
retracted from the counters of their parts and counted again as copies.  So the counters are right after every
micro-batch for the files read so far.  All orders of the filters follow from the number of documents by part and mask.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cardloom.llm.shared import new_folder, pieces_for, same_text, staged

#: A copy is no property of a document alone: it is told by the state.
COPY = "E"
GOOD, TOXIC = 64, 128
TEXTS_PER_STATE = 2_000
#: State is kept in as many partitions as this asks for, not in the session's number, which a small table need not have.
ROWS_PER_PARTITION, MOST_PARTITIONS = 50_000, 10_000
BATCHES = 4


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def conditions(text: Column) -> dict[str, Column]:
    """Filters by letter, as the condition under which a document fails; ``COPY`` comes from the state."""
    w = words(text)
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(w) < 200,
        "B": 100 * F.size(F.array_distinct(w)) < 50 * F.size(w),
        "C": 100 * capitals > 3 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def flags_of(labels: DataFrame) -> DataFrame:
    """(_id, _marks): one row per labelled document, ``GOOD`` and ``TOXIC`` set where any of its labels says so."""
    marks = F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0))
    rows = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("string").alias("_id"))
    return rows.agg(marks.cast("int").alias("_marks"))


def masked(docs: DataFrame, marks: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """(key, id, part, flags): a row per document without its text; flags are the filters failed and the marks."""
    body = same_text(text)
    failed = sum(((F.when(c, 1 << "ABCDE".index(letter)).otherwise(0)) for letter, c in conditions(body).items()), F.lit(0))
    rows = docs.select(
        F.sha2(F.encode(body, "UTF-8"), 256).alias("key"),
        F.col(key).cast("long").alias("id"),
        same_text(F.col(part).cast("string")).alias("part"),
        failed.cast("int").alias("flags"),
    )
    # Rows without an id meet no label; their text spreads them over the tasks of the join.
    rows = rows.withColumn("_id", F.coalesce(F.col("id").cast("string"), F.col("key")))
    rows = rows.join(marks, "_id", "left")
    return rows.select("key", "id", "part", (F.col("flags") + F.coalesce("_marks", F.lit(0))).alias("flags"))


BIT_COPY = 1 << "ABCDE".index(COPY)
KEY = ["high", "low"]
ROW = "high long, low long, id long, part string, flags int, n long, first boolean"


def combined(states: int):
    """Fewer rows before the shuffle: per text only those at the smallest id of a batch keep their text's key apart.

    The others are copies whatever comes; so a text that a third of the rows have sends a few rows per batch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            digest = np.array([bytes.fromhex(k[:32]) for k in batch.pop("key")], "S16")
            numbers = np.frombuffer(digest.tobytes().ljust(16 * len(batch), b"\0"), ">i8").reshape(-1, 2)
            batch["high"], batch["low"] = numbers[:, 0].astype(np.int64), numbers[:, 1].astype(np.int64)
            low = batch.groupby(KEY)["id"].transform("min")
            known = batch["id"].notna()
            batch["first"] = ~known | (batch["id"] == low).fillna(False).astype(bool)
            batch.loc[~batch["first"], "id"] = pd.NA
            batch["copy"] = ~batch["first"]
            out = batch.groupby([*KEY, "id", "part", "flags", "first"], dropna=False).size().reset_index(name="n")
            out["id"] = out["id"].astype("Int64")
            out["state"] = out["high"] % states
            yield out[["state", *KEY, "id", "part", "flags", "n", "first"]]

    return run


def packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows[[*KEY, "id", "part", "flags", "n"]], preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def settle(held: pd.DataFrame | None, new: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The state after ``new`` rows, and the change of the counters as (part, flags, n).

    ``held`` and the new state have the rows at the smallest id of every text.
    """
    loose = new[new["id"].isna()]
    # Rows without an id are nobody's copy; the others here were told to be copies before the shuffle.
    change = [loose.assign(flags=loose["flags"] | np.where(loose["first"], 0, BIT_COPY))]
    rows = new[new["id"].notna()].assign(id=lambda d: d["id"].astype(np.int64), old=False)[[*KEY, "id", "part", "flags", "n", "old"]]
    if held is not None:
        rows = pd.concat([held.assign(old=True), rows], ignore_index=True)
    if len(rows):
        lowest = rows["id"] == rows.groupby(KEY)["id"].transform("min")
        copy, old = rows[~lowest], rows["old"]
        change.append(rows[lowest & ~old])
        change.append(copy.assign(flags=copy["flags"] | BIT_COPY))
        retracted = rows[~lowest & old]
        change.append(retracted.assign(n=-retracted["n"]))
        rows = rows[lowest].groupby([*KEY, "id", "part", "flags"], as_index=False)["n"].sum()
    counted = pd.concat([c[["part", "flags", "n"]] for c in change], ignore_index=True)
    counted = counted.groupby(["part", "flags"], as_index=False)["n"].sum()
    return rows, counted[counted["n"] != 0]


def keep_smallest(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = unpacked(state.get[0]) if state.exists else None
    held, change = settle(held, pd.concat(list(batches), ignore_index=True))
    if len(held):
        state.update((packed(held),))
    yield change


def changes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The changes of a task added up before they are written."""
    found = [b for b in batches if len(b)]
    if found:
        out = pd.concat(found, ignore_index=True).groupby(["part", "flags"], as_index=False)["n"].sum()
        yield out[out["n"] != 0]


@dataclass(frozen=True)
class Source:
    """Files of documents: their path, the number of rows and how many files a micro-batch takes."""

    docs: DataFrame
    path: str
    rows: int
    files_per_batch: int


def source(spark: SparkSession, path: str, batches: int = BATCHES) -> Source:
    docs = spark.read.parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(folder).isFile():
        # A stream reads folders and patterns; this pattern is of one file.
        path = f"{path[:-1]}[{path[-1]}]"
    return Source(docs, path, docs.count(), max(1, -(-len(docs.inputFiles()) // batches)))


def count_masks(spark: SparkSession, files: Source, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", folder: str | None = None) -> DataFrame:
    """(part, flags, n): documents by part, filters failed and marks, from a run over all files.

    The changes of the micro-batches are written to ``folder`` with the checkpoint of the stream beside them; a run
    with the same folder goes on where the last one stopped and takes only files that it has not seen.  ``labels``
    are read at each micro-batch.
    """
    folder = folder or new_folder(spark, "filter-audit")
    states = pieces_for(files.rows, TEXTS_PER_STATE)
    fields = [f for f in files.docs.schema.fields if f.name in (key, text, part)]
    schema = type(files.docs.schema)(fields)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files.files_per_batch).option("maxFileAge", "36500d")
    rows = masked(reader.parquet(files.path), staged(flags_of(labels), "filter-marks"), key, text, part)
    rows = rows.mapInPandas(combined(states), "state long, " + ROW)
    counters = "part string, flags int, n long"
    counted = rows.groupBy("state").applyInPandasWithState(keep_smallest, counters, "held binary", "append", GroupStateTimeout.NoTimeout)
    out = counted.mapInPandas(changes, counters)
    writer = out.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/changes")
    writer = writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    # A stream takes the settings of its start; its checkpoint remembers the number of partitions.
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(MOST_PARTITIONS, pieces_for(files.rows, ROWS_PER_PARTITION))))
    try:
        stream = writer.start()
    finally:
        spark.conf.set(name, before)
    stream.awaitTermination()
    found = spark.read.schema(counters).parquet(f"{folder}/changes")
    return found.groupBy("part", "flags").agg(F.sum("n").alias("n")).where("n <> 0")


def report(counted: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Per part, order of the filters and step, what the filter of that step does; from counters (part, flags, n).

    Orders and steps are a fixed list of 600; masks of a part are at most 32.
    """
    every = (1 << len(letters)) - 1
    mask = F.col("flags").bitwiseAND(every)
    marked = lambda bit: F.sum(F.when(F.col("flags").bitwiseAND(bit) != 0, F.col("n")).otherwise(0))
    by_mask = counted.groupBy("part", mask.alias("mask")).agg(
        F.sum("n").cast("long").alias("n"), marked(GOOD).cast("long").alias("good"), marked(TOXIC).cast("long").alias("toxic")
    )
    parts = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    steps = []
    for order in permutations(letters):
        ahead = 0
        for step, letter in enumerate(order, 1):
            own = 1 << letters.index(letter)
            steps.append({"filter_order": "".join(order), "step": step, "own": own, "ahead": ahead})
            ahead |= own
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,own:int,ahead:int>>")
    rows = parts.select("part", "masks", F.explode(listed).alias("s")).select("part", "masks", "s.*")

    def added(value: str, when: str) -> Column:
        return F.expr(f"aggregate(masks, 0L, (a, m) -> a + if({when}, m.{value}, 0L))")

    fails, reached = "(m.mask & own) <> 0", "(m.mask & ahead) = 0"
    orders = len(steps) // len(letters)
    return rows.select(
        "part",
        "filter_order",
        "step",
        added("n", f"{reached} and not {fails}").alias("kept"),
        added("n", f"{reached} and {fails}").alias("removed"),
        added("n", f"not {reached} and {fails}").alias("redundant"),
        added("n", "m.mask = own").alias("unique_fails"),
        added("good", f"{reached} and {fails}").alias("good_lost"),
        added("toxic", f"{reached} and {fails}").alias("toxic_lost"),
        # Of the filters that a document fails, each comes first in equally many orders.
        F.expr(f"aggregate(masks, 0L, (a, m) -> a + if({fails}, m.n * {orders} div bit_count(m.mask), 0L))").alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", batches: int = BATCHES) -> DataFrame:
    """All orders of the five filters over the documents of the files at ``path``, by part.

    A NULL text is empty, and a NULL part is the empty one.  Repeated rows are documents each, and none is a copy of one
    with an equal id.  Rows with a NULL id have no label, are copies of nothing and nothing is a copy of them.  Several
    labels of a document count if any says so.  An empty table gives no rows.
    """
    return report(count_masks(spark, source(spark, path, batches), labels, key, text, part))
