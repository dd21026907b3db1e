"""The row log as runs: (FileID, FirstRow, LastRow) in place of a row per delivered row.

Files are delivered nearly whole, so a file is one run for ever, however many rows it has.  Runs are handled in
blocks of row numbers: a file is never in one task, and a row meets the runs of its own block only.  Many runs
are dealt to as many tasks as their number asks for, since the planner sizes tasks by bytes on disk, and row keys are
many times larger in memory.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions.joins import union_all

FILE, ROW, FIRST, LAST = "FileID", "RowNum", "FirstRow", "LastRow"
RUN = (FILE, FIRST, LAST)
#: Rows of a block; a run is repeated for each block it reaches into, and a block holds half as many runs at most.
BLOCK = 4096
#: Blocks for joining rows to runs are wider, since what lies inside one is sorted, not compared.
WIDE_BLOCK = 1 << 20
#: Rows or cut runs of a task.
ROWS_PER_TASK = 400_000
#: Up to so many runs the planner is left to broadcast them.
FEW = 100_000


def holds_runs(log: DataFrame) -> bool:
    """Whether a log is one of runs."""
    return {FIRST, LAST} <= set(log.columns)


def block_of(row: Column, size: int) -> Column:
    """Number of a row's block, exact for every long."""
    return F.floor((row - F.pmod(row, F.lit(size))) / F.lit(size))


def as_runs(rows: DataFrame) -> DataFrame:
    """Every row a run of its own; rows without a full key match nothing and go."""
    row = F.col(ROW).cast("long")
    keyed = rows.where(F.col(FILE).isNotNull() & F.col(ROW).isNotNull())
    return keyed.select(FILE, row.alias(FIRST), row.alias(LAST))


def in_blocks(runs: DataFrame, size: int) -> DataFrame:
    """Runs cut at the borders of blocks: (FileID, _block, FirstRow, LastRow)."""
    blocks = F.sequence(block_of(F.col(FIRST), size), block_of(F.col(LAST), size))
    cut = runs.where(F.col(FIRST) <= F.col(LAST)).select(FILE, FIRST, LAST, F.explode(blocks).alias("_block"))
    low, high = F.col("_block") * size, F.col("_block") * size + (size - 1)
    return cut.select(FILE, "_block", F.greatest(FIRST, low).alias(FIRST), F.least(LAST, high).alias(LAST))


def cut_count(runs: DataFrame, size: int) -> int:
    """How many runs :func:`in_blocks` makes."""
    held = runs.where(F.col(FIRST) <= F.col(LAST))
    blocks = block_of(F.col(LAST), size) - block_of(F.col(FIRST), size) + 1
    return int(held.agg(F.coalesce(F.sum(blocks), F.lit(0))).first()[0])


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_TASK))


def joined(runs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Overlapping and touching runs of equal ``by`` as one each."""
    order = Window.partitionBy(*by).orderBy(FIRST, LAST)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(LAST).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumns({"_begins": F.coalesce(F.col(FIRST) > reach + 1, F.lit(True)), "_upto": F.max(LAST).over(so_far)})
    first = F.last(F.when(F.col("_begins"), F.col(FIRST)), ignorenulls=True).over(so_far)
    # What ends is known from the next run, so that no run waits in a hash table for others of its island.
    ends = F.lead("_begins", 1, True).over(order)
    found = marked.withColumns({"_first": first, "_ends": ends}).where("_ends")
    return found.select(*by, F.col("_first").alias(FIRST), F.col("_upto").alias(LAST))


def merge_runs(*runs: DataFrame, block: int = WIDE_BLOCK, tasks: int | None = None) -> DataFrame:
    """The fewest runs that cover the same rows, (FileID, FirstRow, LastRow), made in ``tasks`` tasks.

    Runs are joined inside blocks first.  Only those that reach the edge of a block, two a block
    at most, are then joined over a whole file.  Without ``tasks`` the runs are counted.
    """
    every = union_all(*[r.select(*RUN) for r in runs])
    tasks = tasks or tasks_for(cut_count(every, block))
    cut = joined(in_blocks(every, block).repartition(tasks, FILE, "_block"), [FILE, "_block"])
    edge = (F.pmod(FIRST, F.lit(block)) == 0) | (F.pmod(LAST, F.lit(block)) == block - 1)
    over = joined(cut.where(edge).select(*RUN).repartition(tasks, FILE), [FILE])
    return cut.where(~edge).select(*RUN).unionByName(over)


def row_runs(*delivered: DataFrame) -> DataFrame:
    """Delivered rows as runs."""
    return merge_runs(*[as_runs(d.select(FILE, ROW)) for d in delivered])


def append_runs(log: DataFrame, *delivered: DataFrame) -> DataFrame:
    """The log of runs after a delivery, merged; files without new rows pass as they are."""
    new = union_all(*[as_runs(d.select(FILE, ROW)) for d in delivered])
    log, rows = log.select(*RUN), new.count()
    tasks = tasks_for(cut_count(log, WIDE_BLOCK) + rows)
    files = new.select(FILE).distinct()
    if rows > FEW:
        log, files = log.repartition(tasks, FILE), new.select(FILE).repartition(tasks, FILE).distinct()
    touched = log.join(files, FILE, "left_semi")
    return log.join(files, FILE, "left_anti").unionByName(merge_runs(touched, new, tasks=tasks))


def expanded(runs: DataFrame) -> DataFrame:
    """The rows of runs, (FileID, RowNum), once each."""
    blocks = in_blocks(merge_runs(runs), BLOCK)
    return blocks.select(FILE, F.explode(F.sequence(FIRST, LAST)).alias(ROW))


def exclude_runs(df: DataFrame, *logs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of ``df`` that lie in no run; a row without a full key stays.

    An anti join on (FileID, block) with the rows of a run as residual.  The runs of a batch's files are few,
    so the planner broadcasts them by their size and ``df`` is not shuffled; where there are many, both sides
    are dealt by block, and no key has more rows than a block.
    """
    runs = in_blocks(union_all(*[r.select(*RUN) for r in logs]), block)
    runs = runs.select(F.col(FILE).alias("_file"), "_block", FIRST, LAST)
    row = F.col(ROW).cast("long")
    inside = [F.col(FILE) == F.col("_file"), block_of(row, block) == F.col("_block"), row.between(F.col(FIRST), F.col(LAST))]
    return df.join(runs, reduce(lambda a, b: a & b, inside), "left_anti")
