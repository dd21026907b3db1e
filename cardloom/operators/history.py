"""Address history with validity intervals."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions.joins import anti, neighbour, not_in, semi, union_all


def base_events(events: DataFrame, start: date) -> DataFrame:
    """Address events loaded on or after the start date; a timestamp bound reaches the scan."""
    return events.where(F.col("LoadDate") >= F.lit(start).cast("timestamp_ntz"))


def changed_rows(
    events: DataFrame, start: date, key: str = "CustomerGUID", tie: Sequence[str] = (), slice_unit: str = "day"
) -> DataFrame:
    """First event of a customer and events whose UpdatedAt differs from the event before.

    "Before" is by LoadDate over all events from the start date; the test for a
    complete postcode (six characters) comes after it.  A NULL before counts as a
    first event.
    """
    slices = F.date_trunc(slice_unit, "LoadDate")
    seen = neighbour(base_events(events, start), "UpdatedAt", key, ["LoadDate", *tie], slices, "PrevUpdatedAt")
    moved = (F.col("UpdatedAt") != F.col("PrevUpdatedAt")) | F.col("PrevUpdatedAt").isNull()
    return seen.where(moved & (F.length(F.trim("PostCode")) >= 6)).drop("PrevUpdatedAt")


def validity_intervals(
    changed: DataFrame, key: str = "CustomerGUID", tie: Sequence[str] = (), slice_unit: str = "day"
) -> DataFrame:
    """Each kept event with the UpdatedAt of the next one, the end of its validity."""
    slices = F.date_trunc(slice_unit, "UpdatedAt")
    return neighbour(changed, "UpdatedAt", key, ["UpdatedAt", *tie], slices, "NextUpdatedAt", following=True)


@dataclass(frozen=True)
class HistoryState:
    """What a daily run keeps of the events so far.

    ``carried`` is the last event of every customer, ``open`` the last row of every customer's history, and
    ``closed`` the rows before it with the ``UpdatedAt`` of the next.
    """

    carried: DataFrame
    open: DataFrame
    closed: DataFrame


@dataclass(frozen=True)
class HistoryChange:
    """The next ``carried`` and ``open``, the ``closed`` rows to add, and the customers (``renewed``) whose former closed rows they replace."""

    carried: DataFrame
    open: DataFrame
    closed: DataFrame
    renewed: DataFrame


def last_of(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of every key; one struct per key, combined before the shuffle."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(key).agg(F.max_by(whole, F.struct(*[F.col(c) for c in order])).alias("_last")).select("_last.*")


def split_intervals(rows: DataFrame, key: str, tie: Sequence[str], stage, slice_unit: str = "day") -> tuple[DataFrame, DataFrame]:
    """Closed rows, with the ``UpdatedAt`` of the next one, and the last row of every key."""
    slices = F.date_trunc(slice_unit, "UpdatedAt")
    marked = rows.withColumn("_value", F.struct("UpdatedAt"))
    whole = neighbour(marked, "_value", key, ["UpdatedAt", *tie], slices, "_next", following=True).drop("_value")
    whole = stage(whole, "intervals")
    closed = whole.where("_next is not null").select(*rows.columns, F.col("_next.UpdatedAt").alias("NextUpdatedAt"))
    return closed, whole.where("_next is null").select(*rows.columns)


def advance_history(
    state: HistoryState | None,
    events: DataFrame,
    start: date,
    stage: Callable[[DataFrame, str], DataFrame],
    key: str = "CustomerGUID",
    tie: Sequence[str] = (),
) -> HistoryChange:
    """The history after ``events``, all loaded after those of ``state``; older events are not read again.

    Changes are told from the carried last event.  New rows mostly come after the open one of their customer
    and close it.  Where ``UpdatedAt`` goes back behind the open row, the customer's closed rows are
    fetched and their intervals made anew.  :func:`changed_rows` and :func:`validity_intervals` over all events
    give the same rows.  ``stage`` writes what is used more than once.
    """
    events = stage(base_events(events, start).where(F.col(key).isNotNull()), "events")
    columns, by_load, by_update = events.columns, ["LoadDate", *tie], ["UpdatedAt", *tie]
    touched = events.select(key).distinct()
    old = events.limit(0) if state is None else state.carried.select(*columns)
    theirs = semi(old, touched, [key])
    marked = events.withColumn("_new", F.lit(True)).unionByName(theirs.withColumn("_new", F.lit(False)))
    fresh = stage(changed_rows(marked, start, key, tie).where("_new").drop("_new"), "fresh")
    carried = anti(old, touched, [key]).unionByName(last_of(theirs.unionByName(events), key, by_load))
    if state is None:
        closed, last = split_intervals(fresh, key, tie, stage)
        return HistoryChange(carried, last, closed, touched.limit(0))
    moved = fresh.select(key).distinct()
    ends = semi(state.open.select(*columns), moved, [key])
    first = fresh.groupBy(key).agg(F.min(F.struct(*by_update)).alias("_first"))
    late = stage(ends.join(first, key).where(F.struct(*by_update) > F.col("_first")).select(key), "late")
    before = semi(state.closed.select(*columns), late, [key])
    closed, last = split_intervals(before.unionByName(ends).unionByName(fresh), key, tie, stage)
    return HistoryChange(carried, anti(state.open.select(*columns), moved, [key]).unionByName(last), closed, late)


def external_id_map(ids: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Source ids of customers, from the named external sources."""
    return ids.where(F.col("ExternalIDSource").isin(list(sources))).select(
        "CustomerGUID", F.col("ExternalID").alias("SourceUID")
    )


def history_rows(events: DataFrame, external: DataFrame, id_map: DataFrame) -> DataFrame:
    """Changed rows or intervals under the card id of their customer."""
    ids = external.join(id_map.select(F.col("CIN").alias("SourceUID"), "CINID"), "SourceUID")
    return events.join(ids.drop("SourceUID"), "CustomerGUID")


def missing_from_history(
    pii: DataFrame,
    id_map: DataFrame,
    base: DataFrame,
    history: DataFrame,
    duplicates: DataFrame,
    excluded: DataFrame,
    cover_short_postcodes: bool = False,
) -> DataFrame:
    """Current address of customers that have no address event, with an open interval.

    Of ``history`` only the card ids matter, so the changed rows will do in place of
    their intervals.
    A customer whose events all have a short postcode has events but no history and
    appears on neither side; ``cover_short_postcodes`` takes their current address.
    """
    people = pii.join(id_map.select(F.col("CIN").alias("SourceUID"), "CINID"), "SourceUID")
    people = not_in(people, "SourceUID", duplicates.where(F.col("EndDate").isNull()))
    people = not_in(people, "CINID", excluded, "cinid")
    if not cover_short_postcodes:
        people = not_in(people, "CustomerGUID", base)
    people = not_in(people, "CINID", history)
    return people.select("CustomerGUID", "Address1", "Address2", "PostCode", "CINID")


def address_history(history: DataFrame, missing: DataFrame) -> DataFrame:
    """Both sides, each without duplicates, in one table."""
    known = history.select(
        "CINID",
        "CustomerAddress1",
        "CustomerAddress2",
        "CustomerAddress3",
        "PostCode",
        "UpdatedAt",
        "NextUpdatedAt",
    ).distinct()
    types = {f.name: f.dataType for f in known.schema}
    current = missing.select(
        "CINID",
        F.col("Address1").alias("CustomerAddress1"),
        F.col("Address2").alias("CustomerAddress2"),
        F.lit(None).cast(types["CustomerAddress3"]).alias("CustomerAddress3"),
        "PostCode",
        F.lit(None).cast(types["UpdatedAt"]).alias("UpdatedAt"),
        F.lit(None).cast(types["NextUpdatedAt"]).alias("NextUpdatedAt"),
    ).distinct()
    return union_all(known, current)
