"""Helpers of the operators: staging on shared storage, gapless numbers, components, chunked groups."""

from __future__ import annotations

import ctypes
import gc
import json
import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROWS_PER_PIECE = 20_000
CELLS = 1 << 14
#: What a task works on at once.
CHARS_PER_BLOCK = 1 << 20
ROWS_PER_BLOCK = 512


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, the checkpoint folder of the context, and else a folder in
    the warehouse, which is shared wherever tables are.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        folder = spark.sparkContext.getCheckpointDir()
        path = folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return path.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lost executor rereads files."""
    return staged_at(df, new_folder(df.sparkSession, name))


def release(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that nothing reads any more, on whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def same_text(column: str | Column) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def pieces_for(rows: int, per_piece: int = ROWS_PER_PIECE) -> int:
    return max(1, -(-rows // per_piece))


def gapless(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str, pieces: int) -> DataFrame:
    """Numbers 0, 1, 2, ... within each ``group``, without a whole group in one task.

    A group is cut into ``pieces`` by a hash of ``order``; the numbers of a piece start
    after the rows of the pieces before it, known from one aggregate.  ``df`` is read
    twice.  Rows equal in ``order`` are numbered in any order.
    """
    group = list(group)
    cut = df.withColumn("_piece", F.pmod(F.xxhash64(*order), F.lit(pieces)))
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy(*group, "_piece").agg(F.count(F.lit(1)).alias("_rows"))
    starts = starts.select(*group, "_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*group, "_piece").orderBy(*order)
    placed = cut.withColumn("_place", F.row_number().over(inside) - 1)
    joined = placed.join(starts, [*group, "_piece"])
    return joined.select(*df.columns, (F.col("_start") + F.col("_place")).cast("long").alias(out))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, component) per node, component = smallest node.

    Large-star and small-star steps by aggregation and joins until the edges stay the
    same; every round is cut by a checkpoint.  Self loops keep a node with no other edge;
    edges with a NULL end are ignored.  Edges that have not settled in ``rounds`` rounds are an error.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = edges.where("a is not null and b is not null").distinct().checkpoint()
    state = None
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        wide = both.join(low, "a").where("b > a or b = m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        wide = wide.where("a <> b").distinct()
        low = wide.groupBy("a").agg(F.min("b").alias("m"))
        near = wide.join(low, "a")
        near = near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(near.select("a", F.col("m")))
        loops = edges.where("a = b")
        edges = near.where("a <> b").union(loops).distinct().checkpoint()
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state:
            break
        state = mark
    else:
        raise RuntimeError(f"the components have not settled in {rounds} rounds")
    nodes = edges.union(edges.select("b", "b"))
    return nodes.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))


def chunk_pairs(df: DataFrame, group: str, key: str, weight: str, most: int) -> DataFrame:
    """Rows dealt to tasks so that any two rows of a group meet, with no task over about ``2 * most`` weight.

    A group heavier than ``most`` is cut into chunks by a hash of ``key`` and a row goes to every
    pair of chunks with its own, so the rows grow with the number of chunks and not with
    the pairs; lighter groups share tasks.  Added: ``_task``, ``_low`` and ``_high`` (chunk
    pair), ``_chunk`` (the row's own).
    """
    sizes = df.groupBy(group).agg(F.sum(weight).alias("_weight"))
    light = F.col("_weight") <= most
    totals = sizes.agg(F.coalesce(F.sum(F.when(light, F.col("_weight"))), F.lit(0)).alias("t")).first()
    bins = pieces_for(int(totals["t"]), most)
    chunks = F.when(light, F.lit(1)).otherwise(F.ceil(F.col("_weight") / most)).cast("int")
    sizes = sizes.select(group, chunks.alias("_chunks"))
    rows = df.join(sizes, group)
    rows = rows.withColumn("_chunk", F.pmod(F.xxhash64(key), F.col("_chunks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    rows = rows.withColumn("_low", F.least("_chunk", "_other")).withColumn("_high", F.greatest("_chunk", "_other"))
    alone = F.concat(F.lit("b"), F.pmod(F.xxhash64(group), F.lit(bins)))
    named = F.concat_ws("-", F.lit("c"), F.col(group), F.col("_low"), F.col("_high"))
    return rows.withColumn("_task", F.when(F.col("_chunks") == 1, alone).otherwise(named)).drop("_chunks", "_other")


class Cell(NamedTuple):
    cell: int
    bucket: int
    first: int | None


class Cells(NamedTuple):
    """Ranges of a key: ``rows`` deals at most ``CELLS + 3`` cells out to consecutive buckets."""

    low: int
    width: int
    rows: list[Cell]

    def column(self, key: Column) -> Column:
        cell = F.floor((key - F.lit(self.low)) / F.lit(self.width))
        cell = F.greatest(F.lit(-1), F.least(F.lit(CELLS), cell))
        return F.when(key.isNull(), F.lit(-2)).otherwise(cell).cast("long")


def key_cells(df: DataFrame, key: str, weight: Column, per_bucket: int) -> Cells:
    """Cells of equal width over an integer key, merged to buckets of about ``per_bucket`` weight.

    The cells lie between the outer permilles and start and end at multiples of a power of two,
    so the same keys give the same cells.  What lies beyond goes to one cell on each side, NULL keys to
    one before all.  Only counts per cell reach the driver.
    """
    ends = df.agg(F.percentile_approx(key, F.array(F.lit(0.001), F.lit(0.999))).alias("q")).first()["q"]
    low, high = (int(x) for x in ends) if ends else (0, 0)
    width = 1
    while width * (CELLS - 1) < high - low + 1:
        width *= 2
    cells = Cells(low // width * width, width, [])
    counts = df.groupBy(cells.column(F.col(key)).alias("cell")).agg(F.sum(weight).alias("w"), F.min(key).alias("first"))
    held, bucket = 0, 0
    for r in sorted(counts.collect(), key=lambda r: r["cell"]):
        if held >= per_bucket:
            held, bucket = 0, bucket + 1
        cells.rows.append(Cell(r["cell"], bucket, r["first"]))
        held += r["w"] or 0
    return cells


def blocks(texts: Sequence[str | None], chars: int = CHARS_PER_BLOCK, rows: int = ROWS_PER_BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``chars`` characters and at most ``rows`` texts, each of one text at least."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= chars or i + 1 - first >= rows:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def spare_memory() -> None:
    """Give memory that a finished task has freed back to the system: worker processes outlive their tasks and stages."""
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position that each of ``n`` positions reaches over the pairs (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, before[i], low)
        np.minimum.at(root, before[j], low)
        root = root[root]
        if (root == before).all():
            return root


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table from a bounded list of tuples of numbers, by a JSON literal: no Python runs in tasks."""
    names = [c.split()[0] for c in schema.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    parsed = F.from_json(F.lit(text), f"array<struct<{', '.join(c.replace(' ', ':') for c in schema.split(', '))}>>")
    return spark.range(1).select(F.explode(parsed).alias("r")).select("r.*")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
