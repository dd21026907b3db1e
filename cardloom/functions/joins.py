"""Join helpers: existence tests, NULL-aware exclusion, hot-key salting and neighbours in time.

No helper hints a broadcast of data that grows.  Spark broadcasts a side by its
own size check (``autoBroadcastJoinThreshold`` and adaptive execution) and sort-
merges otherwise, splitting skewed partitions of the left side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def semi(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with a partner in ``other``; column order is kept."""
    keys = list(keys)
    return df.join(other.select(*keys), keys, "left_semi").select(*df.columns)


def anti(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` without a partner in ``other``; a NULL key has no partner and stays."""
    keys = list(keys)
    return df.join(other.select(*keys), keys, "left_anti").select(*df.columns)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str | None = None) -> DataFrame:
    """SQL ``NOT IN`` with its NULL rules, as a hash-partitioned anti join.

    A NULL in the list removes every row, and a NULL on the left removes that row
    unless the list is empty.  The planner's own null-aware anti join always
    broadcasts the list; here one scalar says whether it is empty (0), free of NULL
    (1) or not (2).
    """
    name = listed_column or column
    values = listed.select(F.col(name).alias(column))
    nulls = F.count_if(F.col(column).isNull())
    state = F.when(F.count(F.lit(1)) == 0, 0).when(nulls == 0, 1).otherwise(2)
    kept = anti(df, values.where(F.col(column).isNotNull()), [column])
    return kept.where(values.agg(state).scalar() <= F.when(F.col(column).isNotNull(), 1).otherwise(0))


ROWS_PER_SPLIT = 2_000_000
MOST_HOT_KEYS = 100_000


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Keys with more than ``rows_per_split`` rows and the number of pieces to cut them into.

    At most ``rows / rows_per_split`` keys can qualify: half a million for 10^12 rows.  Below
    ``ROWS_PER_SPLIT`` a key must also hold a ``MOST_HOT_KEYS``-th of all rows, so the list,
    which is broadcast, is bounded whatever the caller asks for.
    """
    counts = df.groupBy(*keys).count()
    least = F.lit(rows_per_split)
    if rows_per_split < ROWS_PER_SPLIT:
        least = F.greatest(least, df.agg(F.count(F.lit(1)) / MOST_HOT_KEYS).scalar())
    pieces = F.ceil(F.col("count") / rows_per_split).cast("int").alias("_splits")
    return counts.where(F.col("count") > least).select(*keys, pieces)


def within(table: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Rows of ``table`` in the range that ``column`` has in ``batch``: two scalars, which skip row groups."""
    # Over different inputs, since two scalars of one input are merged into a struct
    # and then filter rows but no longer skip row groups.
    first = batch.agg(F.min(column)).scalar()
    last = batch.where(F.col(column).isNotNull()).agg(F.max(column)).scalar()
    return table.where(F.col(column).between(first, last))


MOST_RANGES = 64


def key_ranges(batch: DataFrame, column: str, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges that hold every value of an integer ``column``, in order.

    The span is cut into equal widths and each is narrowed to the values in it, so what
    reaches the driver is bounded.  Empty without values.
    """
    ends = batch.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    if ends is None or ends["low"] is None:
        return []
    width = (ends["high"] - ends["low"]) // most + 1
    part = F.floor((F.col(column) - F.lit(ends["low"])) / width)
    found = batch.where(F.col(column).isNotNull()).groupBy(part.alias("_part"))
    rows = found.agg(F.min(column).alias("low"), F.max(column).alias("high")).collect()
    return sorted((r["low"], r["high"]) for r in rows)


def in_ranges(table: DataFrame, column: str, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows whose ``column`` lies in one of the ranges, as literals that skip files and row groups."""
    inside = [F.col(column).between(low, high) for low, high in ranges]
    return table.where(reduce(lambda a, b: a | b, inside, F.lit(False)))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    salt_by: Sequence[str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi join in which hot keys of the left side are cut into pieces.

    For right sides that are aggregated on the join key: they come out partitioned,
    Spark adds no shuffle there, and adaptive execution then does not split the left
    side.  Hot left rows are dealt out by a hash of ``salt_by`` and only the right
    rows of hot keys are repeated.  The hot list is bounded (see :func:`hot_keys`),
    so it is broadcast; it may be over some of the join keys only.  Rows with a NULL
    key have no partner and are spread too.
    """
    keys = list(keys)
    hot = F.broadcast(hot_keys(left, keys) if hot is None else hot)
    hot_by = [c for c in hot.columns if c != "_splits"]
    dice = F.xxhash64(*salt_by)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salt = (
        F.when(no_key, F.pmod(dice, F.lit(1024)))
        .when(F.col("_splits").isNull(), F.lit(0))
        .otherwise(F.pmod(dice, F.col("_splits")))
    )
    spread = left.join(hot, hot_by, "left").select(*left.columns, salt.cast("int").alias("_salt"))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_splits"), F.lit(1)) - 1))
    repeated = right.join(hot, hot_by, "left").select(*right.columns, copies.alias("_salt"))
    joined = spread.join(repeated, [*keys, "_salt"], how)
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in keys]
    return joined.select(*left.columns, *added)


def with_group_values(
    df: DataFrame, keys: Sequence[str], salt_by: Sequence[str], **values: Column
) -> DataFrame:
    """Rows with aggregate values of their group.

    Like a window without an order, but aggregated before the shuffle and joined
    back, so a group of any size is spread over tasks.
    """
    groups = df.groupBy(*keys).agg(*[v.alias(name) for name, v in values.items()])
    return salted_join(df, groups, keys, "left", salt_by)


def neighbour(
    df: DataFrame,
    value: str,
    key: str,
    order: Sequence[str],
    slice_of: Column,
    out: str,
    following: bool = False,
) -> DataFrame:
    """Previous (or following) ``value`` of the same ``key`` in ascending ``order``.

    A plain window over ``key`` puts a whole key into one task.  Here the key is
    cut into time slices (``slice_of`` must not decrease along ``order``): a window
    inside each slice, one carried value per slice from a pre-aggregated table,
    and a join of the two.  Rows with a NULL key are not returned.
    """
    rank = F.struct(*[F.col(c) for c in order])
    base = df.where(F.col(key).isNotNull()).withColumn(
        "_slice", F.coalesce(slice_of.cast("timestamp"), F.lit("0001-01-01").cast("timestamp"))
    )
    ordering = [F.col(c).desc() if following else F.col(c).asc() for c in order]
    inside = Window.partitionBy(key, "_slice").orderBy(*ordering)
    near = base.withColumn("_near", F.lag(value).over(inside)).withColumn("_place", F.row_number().over(inside))
    edge = F.min_by(value, rank) if following else F.max_by(value, rank)
    slices = Window.partitionBy(key).orderBy(F.col("_slice").desc() if following else F.col("_slice").asc())
    carried = (
        base.groupBy(key, "_slice")
        .agg(edge.alias("_edge"))
        .select(key, "_slice", F.lag("_edge").over(slices).alias("_carried"))
    )
    found = F.when(F.col("_place") == 1, F.col("_carried")).otherwise(F.col("_near"))
    return near.join(carried, [key, "_slice"], "inner").select(*df.columns, found.alias(out))


def binned(periods: DataFrame, start: str, end: str, batch: DataFrame, day: str, unit: str, out: str) -> DataFrame:
    """Half-open date periods once for each bin of time they touch, cut to the bins that ``batch`` has days in.

    Joined on their keys and the bin, with the range as residual, a day meets a period in the day's own bin
    only: each pair comes out once, and a day is compared with the periods of its bin, not with all of its key.  An open
    end costs no more bins than the batch spans (two scalars).
    """
    first = batch.agg(F.min(day)).scalar()
    last = batch.where(F.col(day).isNotNull()).agg(F.max(day)).scalar()
    low = F.date_trunc(unit, F.greatest(F.col(start), first)).cast("date")
    high = F.least(F.date_sub(end, 1), last)
    step = {"week": "interval 7 days", "month": "interval 1 month", "year": "interval 1 year", "day": "interval 1 day"}[unit]
    bins = F.when((F.col(start) < F.col(end)) & (low <= high), F.sequence(low, high, F.expr(step)))
    return periods.withColumn(out, F.explode(bins))
