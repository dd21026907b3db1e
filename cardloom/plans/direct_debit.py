"""Direct-debit run: transactions, dimensions, export and log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from cardloom.config import DirectDebitConfig, RunContext
from cardloom.operators.direct_debit import (
    brand_taxonomy,
    dd_customers,
    dd_eligible,
    dd_feed,
    dd_merchant_details,
    dd_merchants,
    drop_max_id_duplicates,
    drop_unbranded_duplicates,
    export_file_count,
    proxy_mapping,
)
from cardloom.operators.incremental import log_rows
from cardloom.plans.run_log import Deliver, deliver_logged
from cardloom.sources.files import export_exact, export_feed
from cardloom.sources.publish import publish
from cardloom.sources.tables import append_run, empty_staged, refuse_repeat, staged, write_version


@dataclass(frozen=True)
class DirectDebitTables:
    transactions: DataFrame
    programme_transactions: DataFrame
    row_log: DataFrame
    customers: DataFrame
    pii: DataFrame
    id_map: DataFrame
    duplicates: DataFrame
    post_areas: DataFrame
    accounts: DataFrame
    merchants: DataFrame
    brands: DataFrame
    sectors: DataFrame
    sector_groups: DataFrame
    taxonomy_mask: DataFrame
    merchant_mask: DataFrame
    earlier_customers: DataFrame
    affinity: DataFrame
    cards: DataFrame
    historic_mapping: DataFrame
    mapping_overrides: DataFrame


def direct_debit_rows(t: DirectDebitTables, tx: DataFrame, config: DirectDebitConfig, run: RunContext) -> DataFrame:
    """Feed rows of the given transactions.

    The dimensions are not cut down to the batch first: the joins do that, with
    runtime filters where they pay.
    """
    people = drop_max_id_duplicates(dd_customers(tx, t.customers, t.pii, t.id_map, t.duplicates, t.post_areas))
    return dd_feed(tx, people, t.accounts, t.merchants, config, run.today)


def run_direct_debit(
    t: DirectDebitTables,
    config: DirectDebitConfig,
    run: RunContext,
    out: str,
    work: str | None = None,
    deliver: Deliver | None = None,
) -> dict[str, str]:
    """One direct-debit run; rows are logged only after the export has succeeded.

    Taxonomy and merchant details share one list of masked brands, the two merchant tables the
    other.  The mapping is exported in as many files as the table of their number says.  Details look at the transactions of the programme, not at those of the feed.
    """
    log_path = f"{out}/dd_row_log"
    refuse_repeat(t.row_log.sparkSession, log_path, run.run_id)
    eligible = dd_eligible(t.transactions, t.customers, t.row_log, config, prune_by="FileID")
    tx = staged(eligible, "dd-tx", run.run_id, work)
    feed = staged(direct_debit_rows(t, tx, config, run), "dd-feed", run.run_id, work)
    details = dd_merchant_details(
        t.merchants, t.brands, t.taxonomy_mask, t.programme_transactions, t.earlier_customers
    )
    mapping = proxy_mapping(
        t.programme_transactions,
        t.customers,
        t.id_map,
        t.earlier_customers,
        t.affinity,
        t.cards,
        t.accounts,
        t.historic_mapping,
        t.mapping_overrides,
        t.duplicates,
        stage=lambda df, name: staged(df, f"dd-{name}", run.run_id, work),
    )
    mapping = staged(mapping, "dd-mapping", run.run_id, work)
    by_key = dd_merchants(t.merchants, t.brands, t.merchant_mask)
    tables = {
        "brand_taxonomy": brand_taxonomy(t.merchants, t.brands, t.sectors, t.sector_groups, t.taxonomy_mask),
        "dd_merchant_details": drop_unbranded_duplicates(details, "ProxyOINTupleID", config.unbranded_brand),
        "dd_merchants": drop_unbranded_duplicates(by_key, "ProxyOINTupleID", config.unbranded_brand),
        "proxy_mapping": mapping,
        "proxy_mapping_files": export_file_count(mapping),
        "dd_merchants_by_id": dd_merchants(t.merchants, t.brands, t.merchant_mask, keyed_by_id=True),
    }
    paths = {name: write_version(df, f"{out}/{name}", run.run_id) for name, df in tables.items()}
    paths["proxy_mapping_export"] = export_exact(mapping, f"{out}/proxy_mapping_export/run={run.run_id}", run.today, run_id=run.run_id, work=work)
    paths["feed"] = export_feed(feed, f"{out}/dd_feed/run={run.run_id}", run.today)
    deliver_logged(t.row_log.sparkSession, deliver, paths["feed"], 4, run, out, work)
    publish(t.row_log.sparkSession, f"{out}/published/direct_debit", run.run_id, paths, again=True)
    append_run(log_rows(feed, processed_at=run.as_of), log_path, run.run_id)
    empty_staged(t.row_log.sparkSession, "dd-", run.run_id, work)
    empty_staged(t.row_log.sparkSession, "export", run.run_id, work)
    return paths
