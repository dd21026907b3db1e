"""Quarantine run: pseudonymised customers first, then the held transactions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from cardloom.config import AffinityConfig, RunContext
from cardloom.operators.affinity import (
    affinity_population,
    preferred_card,
    proxy_user_id,
    row_checksums,
    upsert_changed,
)
from cardloom.operators.incremental import log_rows
from cardloom.operators.quarantine import hold_credit, hold_debit, normalise_quarantine, quarantine_feed
from cardloom.plans.run_log import Deliver, deliver_logged
from cardloom.sources.files import export_feed
from cardloom.sources.tables import append_run, empty_staged, refuse_repeat, staged, write_version


@dataclass(frozen=True)
class QuarantineTables:
    pending_debit: DataFrame
    pending_credit: DataFrame
    row_log: DataFrame
    id_map: DataFrame
    customers: DataFrame
    mcc: DataFrame
    times: DataFrame
    locations: DataFrame
    merchant_zips: DataFrame
    duplicate_cins: DataFrame


def affinity_source(
    customers: DataFrame, id_map: DataFrame, consents: DataFrame, secondary: DataFrame, config: AffinityConfig
) -> DataFrame:
    """Today's population with pseudonym and checksum."""
    primary = preferred_card(customers, id_map, consents, config.primary_clubs)
    population = affinity_population(primary, secondary, config.secondary_clubs)
    return row_checksums(proxy_user_id(population, config.pseudonym_offset))


def run_affinity(target: DataFrame, source: DataFrame, run: RunContext, out: str) -> str:
    """New version of the pseudonymised customer table."""
    return write_version(upsert_changed(target, source), f"{out}/affinity_customers", run.run_id)


def run_quarantine(
    t: QuarantineTables,
    affinity: DataFrame,
    unbranded_brand: int,
    run: RunContext,
    out: str,
    work: str | None = None,
    deliver: Deliver | None = None,
) -> str:
    """One quarantine run; every held row is logged once the feed is written."""
    log_path = f"{out}/quarantine_row_log"
    refuse_repeat(t.row_log.sparkSession, log_path, run.run_id)
    debit = staged(hold_debit(t.pending_debit, affinity, t.row_log, "FileID"), "held-debit", run.run_id, work)
    credit = staged(hold_credit(t.pending_credit, affinity, t.row_log, "FileID"), "held-credit", run.run_id, work)
    feed = quarantine_feed(
        normalise_quarantine(debit, credit, affinity, t.mcc, t.times, "FileID"),
        t.id_map,
        t.customers,
        t.locations,
        t.merchant_zips,
        t.duplicate_cins,
        unbranded_brand,
        run.as_of,
    )
    path = export_feed(feed, f"{out}/quarantine_feed/run={run.run_id}", run.load_date)
    deliver_logged(t.row_log.sparkSession, deliver, path, 3, run, out, work)
    append_run(log_rows(debit, credit), log_path, run.run_id)
    empty_staged(t.row_log.sparkSession, "held-", run.run_id, work)
    return path


