"""Dimension runs that come before the card feeds: cohorts, customers, merchants, address history."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardloom.config import RunContext
from cardloom.functions.joins import union_all
from cardloom.functions.keys import clean_narrative
from cardloom.operators.address import address_candidates, refresh_cohorts
from cardloom.operators.customer import customer_feed, customer_profile
from cardloom.operators.history import (
    HistoryState,
    address_history,
    advance_history,
    base_events,
    changed_rows,
    external_id_map,
    history_rows,
    missing_from_history,
    validity_intervals,
)
from cardloom.operators.merchant import (
    clean_narratives_incremental,
    merchant_base,
    merchant_detail,
    merchant_keys,
    upsert_merchants,
)
from cardloom.plans.run_log import Deliver, deliver_logged, log_delivery
from cardloom.sources.files import export_exact, import_files, import_split
from cardloom.sources.publish import publish, published, refuse_published, versions
from cardloom.sources.tables import empty_staged, empty_tables, staged, work_dir, write_version


@dataclass(frozen=True)
class CohortTables:
    state: DataFrame
    customers: DataFrame
    pii: DataFrame
    details: DataFrame
    id_map: DataFrame
    address_file: DataFrame
    cohorts: DataFrame
    defaults: DataFrame


def run_cohorts(t: CohortTables, run: RunContext, out: str, work: str | None = None) -> str:
    """Match addresses and write the new cohort state."""
    state = refresh_cohorts(
        t.state,
        address_candidates(t.customers, t.pii, t.cohorts),
        t.address_file,
        t.cohorts,
        t.defaults,
        t.details,
        t.id_map,
        run.as_of,
        stage=lambda df, name: staged(df, f"cohorts-{name}", run.run_id, work),
    )
    return write_version(state, f"{out}/cohort_state", run.run_id)


def purge_cohorts(state: DataFrame, run: RunContext, out: str, work: str | None = None) -> str:
    """Remove matched addresses once the customer feed has been built, for privacy.

    Every version of the state and the intermediate tables of all cohort runs are replaced by empty
    ones; ``state`` gives the columns of the new version and is not read.
    """
    spark = state.sparkSession
    path = write_version(spark.createDataFrame([], state.schema), f"{out}/cohort_state", f"{run.run_id}-purged")
    empty_tables(spark, f"{out}/cohort_state/version=*")
    empty_tables(spark, f"{work_dir(spark, work)}/*/cohorts-*")
    return path


@dataclass(frozen=True)
class CustomerTables:
    customers: DataFrame
    details: DataFrame
    id_map: DataFrame
    acorn: DataFrame
    cameo: DataFrame
    cameo_group: DataFrame
    cohort_state: DataFrame
    duplicates: DataFrame
    excluded: DataFrame


def run_customers(t: CustomerTables, run: RunContext, out: str, detailed: bool = False) -> str:
    """Customer feed; the detailed one takes the postal sector from the postcode and has the postcode too."""
    profile = customer_profile(
        t.customers,
        t.id_map,
        t.acorn,
        t.cameo,
        t.cameo_group,
        t.cohort_state,
        t.duplicates,
        t.excluded,
        details=t.details,
        sector_from_postcode=detailed,
    )
    name = "customers_detailed" if detailed else "customers"
    return write_version(customer_feed(t.id_map, profile, detailed), f"{out}/{name}", run.run_id)


@dataclass(frozen=True)
class MerchantTables:
    merchants: DataFrame
    feed_merchants: DataFrame
    upstream_merchants: DataFrame
    postcodes: DataFrame
    alternates: DataFrame
    locations: DataFrame
    narrative_cache: DataFrame
    mcc: DataFrame


def run_merchants(
    t: MerchantTables,
    run: RunContext,
    out: str,
    clean: Callable[[Column], Column] = clean_narrative,
    work: str | None = None,
) -> dict[str, str]:
    """Clean new narratives, then build the keyed, detailed and upserted merchant tables."""
    fresh = clean_narratives_incremental(t.merchants, t.narrative_cache, clean)
    cache = staged(union_all(t.narrative_cache, fresh), "narratives", run.run_id, work)
    base = merchant_base(t.merchants, t.postcodes, t.alternates, t.locations, cache)
    tables = {
        "narrative_cache": cache,
        "merchant_keys": merchant_keys(base, t.mcc),
        "merchant_detail": merchant_detail(t.merchants, t.postcodes, t.alternates, t.locations),
        "merchants": upsert_merchants(t.feed_merchants, t.upstream_merchants),
    }
    paths = {name: write_version(df, f"{out}/{name}", run.run_id) for name, df in tables.items()}
    empty_staged(cache.sparkSession, "narratives", run.run_id, work)
    return paths


@dataclass(frozen=True)
class AddressTables:
    events: DataFrame
    external_ids: DataFrame
    id_map: DataFrame
    pii: DataFrame
    duplicates: DataFrame
    excluded: DataFrame
    tie: tuple[str, ...] | None = None


def run_address_history(
    t: AddressTables, sources: Sequence[str], start: date, run: RunContext, out: str, work: str | None = None
) -> str:
    """Address history; the changed rows feed both sides and are written once.

    Events of equal time are put in order by the ``tie`` columns, by default by all of them, so a
    repeated task gives the same rows.
    """
    tie = list(t.events.columns if t.tie is None else t.tie)
    changed = staged(changed_rows(t.events, start, tie=tie), "changed-addresses", run.run_id, work)
    external = external_id_map(t.external_ids, sources)
    history = history_rows(validity_intervals(changed, tie=tie), external, t.id_map)
    missing = missing_from_history(
        t.pii,
        t.id_map,
        base_events(t.events, start),
        history_rows(changed, external, t.id_map),
        t.duplicates,
        t.excluded,
    )
    path = write_version(address_history(history, missing), f"{out}/address_history", run.run_id)
    empty_staged(changed.sparkSession, "changed-addresses", run.run_id, work)
    return path


def address_state(spark: SparkSession, root: str, key: str = "CustomerGUID") -> HistoryState | None:
    """The last published state of the daily address history under ``root``; None before the first run."""
    paths = published(spark, f"{root}/versions")
    if not paths:
        return None
    closed = spark.read.parquet(*paths["closed"])
    renewed = spark.read.parquet(*paths["renewed"]).groupBy(key).agg(F.max("_run").alias("_since"))
    closed = closed.join(renewed, key, "left").where("_since is null or _run >= _since").drop("_run", "_since")
    return HistoryState(spark.read.parquet(*paths["carried"]), spark.read.parquet(*paths["open"]), closed)


def run_address_history_daily(
    spark: SparkSession, events: DataFrame, start: date, run: RunContext, root: str, tie: Sequence[str], work: str | None = None
) -> dict[str, list[str]]:
    """Advance the address history by the events loaded since the last run.

    Closed rows are appended; where a customer's are made anew, the run says so and readers skip the former ones.  The last
    and the open row of every customer are a new version.  One manifest makes all of it visible at the end,
    so a run that fails is repeated; a run that is published is refused.
    """
    refuse_published(spark, f"{root}/versions", run.run_id)
    before, number = published(spark, f"{root}/versions"), len(versions(spark, f"{root}/versions")) + 1
    stage = lambda df, what: staged(df, f"history-{what}", run.run_id, work)
    change = advance_history(address_state(spark, root), events, start, stage, tie=tie)
    marked = lambda df: df.withColumn("_run", F.lit(number))
    paths = {
        "carried": [write_version(change.carried, f"{root}/carried", run.run_id)],
        "open": [write_version(change.open, f"{root}/open", run.run_id)],
        "closed": [*before.get("closed", []), write_version(marked(change.closed), f"{root}/closed", run.run_id)],
        "renewed": [*before.get("renewed", []), write_version(marked(change.renewed), f"{root}/renewed", run.run_id)],
    }
    publish(spark, f"{root}/versions", run.run_id, paths)
    empty_staged(spark, "history-", run.run_id, work)
    return paths


def daily_address_history(t: AddressTables, state: HistoryState, sources: Sequence[str]) -> DataFrame:
    """The address history table of a state; ``t.events`` is not read."""
    external = external_id_map(t.external_ids, sources)
    open_end = F.lit(None).cast(state.open.schema["UpdatedAt"].dataType)
    rows = state.closed.unionByName(state.open.withColumn("NextUpdatedAt", open_end))
    kept = history_rows(state.open, external, t.id_map)
    missing = missing_from_history(t.pii, t.id_map, state.carried, kept, t.duplicates, t.excluded)
    return address_history(history_rows(rows, external, t.id_map), missing)


def run_cohort_ingest(spark: SparkSession, path: str, schema: StructType | str, run: RunContext, out: str, **more) -> str:
    """Read a partner's file of hashed addresses and their cohorts as the new cohort table, see :func:`run_ingest`."""
    return run_ingest(spark, path, schema, run, out, "cohorts", 5, **more)


def run_default_ingest(spark: SparkSession, path: str, schema: StructType | str, run: RunContext, out: str, **more) -> str:
    """Read a partner's file of postcodes and their default cohorts as the new table of defaults, see :func:`run_ingest`."""
    return run_ingest(spark, path, schema, run, out, "cohort_defaults", 6, **more)


def run_ingest(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    run: RunContext,
    out: str,
    name: str,
    number: int,
    output: str | None = None,
    most_bad: float | None = None,
    work: str | None = None,
    **options: str,
) -> str:
    """Read partner files as a new version of table ``name`` and return its path.

    ``output`` is the console output of the transfer: it becomes log lines, and an error there stops the run before a file is
    read.  Without ``most_bad`` a single bad row fails the read; with it, bad rows are kept in ``<name>_rejects``.
    """
    if output is not None:
        log_delivery(spark, output, number, run, out, work=work)
    if most_bad is None:
        return write_version(import_files(spark, path, schema, **options), f"{out}/{name}", run.run_id)
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    split = import_split(spark, path, schema, f"{run.run_id}/{name}", most_bad, work, **options)
    write_version(split.rejects, f"{out}/{name}_rejects", run.run_id)
    target = write_version(split.good, f"{out}/{name}", run.run_id)
    empty_staged(spark, "", f"{run.run_id}/{name}", work)
    return target


def run_cohort_export(
    spark: SparkSession,
    state: DataFrame,
    run: RunContext,
    out: str,
    rows_per_file: int = 2_000_000,
    deliver: Deliver | None = None,
    work: str | None = None,
) -> str:
    """Export the current cohort of every customer for the partner, in exactly as many files as it takes, and log the delivery."""
    current = state.where(F.col("isCurrentCohort") == 1).select("CINID", "microcell_id", "HashedAddress", "loadDate")
    target = export_exact(current, f"{out}/cohort_export/run={run.run_id}", run.today, rows_per_file, run_id=run.run_id, work=work)
    deliver_logged(spark, deliver, target, 3, run, out, work)
    empty_staged(spark, "export", run.run_id, work)
    return target
