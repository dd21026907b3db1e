"""Direct-debit dimensions and transaction feed."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.config import DirectDebitConfig
from cardloom.functions.bands import AGE_DETAILED, band
from cardloom.functions.compat import age_in_years, text_key
from cardloom.functions.joins import anti, semi, union_all, within
from cardloom.functions.keys import dd_oin_base64, dd_tuple_key, without_commas
from cardloom.operators.incremental import exclude_logged

NO_LIMIT = date(9999, 12, 31)


def mask_brand(df: DataFrame, mask: DataFrame, **labels: str) -> DataFrame:
    """Group labels in place of brand texts.

    ``BrandName="_name"`` sets column BrandName to the mask's BrandName, or to column
    ``_name`` where the brand is not masked.  ``mask`` has one row per masked brand,
    so each feed can have its own list.
    """
    chosen = mask.select("BrandID", *[F.col(c).alias(f"_mask_{c}") for c in labels])
    named = df.join(chosen, "BrandID", "left")
    texts = {c: F.coalesce(F.col(f"_mask_{c}"), F.col(own)) for c, own in labels.items()}
    return named.withColumns(texts).drop(*[f"_mask_{c}" for c in labels])


def brand_taxonomy(
    merchants: DataFrame, brands: DataFrame, sectors: DataFrame, groups: DataFrame, mask: DataFrame
) -> DataFrame:
    """Distinct brands in use with masked name, sector group and sector."""
    used = semi(brands, merchants.select("BrandID").distinct(), ["BrandID"])
    placed = used.join(sectors, "SectorID").join(groups, "SectorGroupID")
    masked = mask_brand(placed.withColumnRenamed("BrandName", "_name"), mask, BrandName="_name")
    return masked.select("BrandID", "BrandName", "GroupName", "SectorName").distinct()


def dd_merchant_details(
    merchants: DataFrame, brands: DataFrame, mask: DataFrame, tx: DataFrame, customers: DataFrame
) -> DataFrame:
    """Distinct masked merchants with at least one transaction of a known customer."""
    theirs = semi(tx.select("ConsumerCombinationID_DD", "FanID"), customers, ["FanID"])
    used = semi(merchants, theirs.select("ConsumerCombinationID_DD").distinct(), ["ConsumerCombinationID_DD"])
    named = used.join(brands.select("BrandID", F.col("BrandName").alias("_name")), "BrandID")
    named = mask_brand(named, mask, BrandName="_name", MerchantNarrative="Narrative_RBS")
    return named.select(
        dd_tuple_key("Narrative_RBS", F.col("OIN").cast("string")).alias("ProxyOINTupleID"),
        dd_oin_base64("OIN").alias("ProxyOIN"),
        "BrandID",
        "BrandName",
        "MerchantNarrative",
    ).distinct()


def drop_unbranded_duplicates(df: DataFrame, key: str, unbranded_brand: int) -> DataFrame:
    """Drop unbranded rows whose key occurs more than once.

    The unbranded id may own much of the table, so the test is an anti join against
    pre-aggregated keys, not a window over them.
    """
    repeated = df.groupBy(key).count().where((F.col("count") > 1) & F.col(key).isNotNull()).select(key)
    marked = repeated.withColumn("BrandID", F.lit(unbranded_brand).cast(df.schema["BrandID"].dataType))
    return anti(df, marked, [key, "BrandID"])


def dd_merchants(merchants: DataFrame, brands: DataFrame, mask: DataFrame, keyed_by_id: bool = False) -> DataFrame:
    """Distinct merchants with masked brand and narrative.

    Keyed by the tuple key, or by the merchant id with commas taken out of the
    narrative.  A merchant without a brand row keeps its own narrative.
    """
    known = brands.select("BrandID", F.col("BrandName").alias("_name"), F.col("BrandID").alias("_own"))
    named = merchants.join(known, "BrandID", "left").withColumn("BrandID", F.col("_own"))
    named = mask_brand(named, mask, BrandName="_name", MerchantNarrative="Narrative_RBS")
    if keyed_by_id:
        key, narrative = F.col("ConsumerCombinationID_DD"), without_commas("MerchantNarrative")
    else:
        key = dd_tuple_key("Narrative_RBS", F.col("OIN").cast("string")).alias("ProxyOINTupleID")
        narrative = F.col("MerchantNarrative")
    return named.select(key, "OIN", "BrandID", "BrandName", narrative.alias("Narrative")).distinct()


def proxy_mapping(
    tx: DataFrame,
    customers: DataFrame,
    id_map: DataFrame,
    earlier_customers: DataFrame,
    affinity: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    historic: DataFrame,
    overrides: DataFrame,
    duplicates: DataFrame,
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """Customer, pseudonym and account triples of four sources, plus customers in none of them.

    Transactions are reduced to distinct (customer, account) pairs first, and the four sources to
    distinct triples, which ``stage`` may write, since they are used twice.  The
    pseudonym is upper-case hex.
    """
    ids = id_map.select(F.col("CIN").alias("SourceUID"), "CINID")
    people = customers.select("FanID", "CustomerGUID", "SourceUID")
    with_id = people.join(ids, "SourceUID")
    hexed = F.upper(F.hex("ProxyUserID")).alias("NeonProxyUserID")
    shape = [
        F.col("CINID").alias("ProxyUserID"),
        "NeonProxyUserID",
        F.col("BankAccountGUID").alias("ProxyAccountID"),
    ]

    debited = (
        tx.select("FanID", "BankAccountID")
        .distinct()
        .join(with_id.select("FanID", "CINID"), "FanID")
        .join(earlier_customers.select("FanID", hexed), "FanID", "left")
        .join(accounts.select("BankAccountID", "BankAccountGUID"), "BankAccountID")
        .select(*shape)
    )
    guids = accounts.select("BankAccountGUID")
    held = cards.select("CustomerGUID", F.col("AccountGUID").alias("BankAccountGUID"))
    held = held.join(guids.withColumn("_known", F.lit(True)), "BankAccountGUID", "left")
    held = held.withColumn("BankAccountGUID", F.when(F.col("_known"), F.col("BankAccountGUID"))).drop("_known")
    carded = (
        affinity.select("FanID", "SourceUID", hexed)
        .join(ids, "SourceUID")
        .join(people.select("FanID", "CustomerGUID"), "FanID", "left")
        .join(held, "CustomerGUID", "left")
        .select(*shape)
    )
    old = historic.join(earlier_customers.select("CINID", hexed), "CINID", "left").select(*shape)
    fixed = overrides.select(
        F.col("cinid").alias("ProxyUserID"),
        F.col("neonproxyuserid").alias("NeonProxyUserID"),
        F.col("bankaccountguid").alias("ProxyAccountID"),
    )
    combined = stage(union_all(debited, carded, old, fixed).distinct(), "triples")
    active = anti(with_id, duplicates, ["SourceUID"]).select(F.col("CINID").alias("ProxyUserID"))
    absent = anti(active, combined, ["ProxyUserID"]).distinct()
    return union_all(combined, absent).distinct()


def export_file_count(df: DataFrame, rows_per_file: int = 2_000_000) -> DataFrame:
    """Number of files of at most ``rows_per_file`` rows."""
    return df.agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).alias("filecount"))


def dd_eligible(
    tx: DataFrame, customers: DataFrame, log: DataFrame, config: DirectDebitConfig, prune_by: str | None = None
) -> DataFrame:
    """Undelivered transactions before the limit date of their customer.

    The limit is the deactivation date, less the grace days from the cutover on; a
    customer without one has no limit.  ``prune_by`` cuts the log to the range of all
    transactions given.
    """
    if prune_by is not None:
        log = within(log, tx, prune_by)
    left = F.col("DeactivatedDate")
    shifted = F.when(left >= F.lit(config.cutover), F.date_sub(left, config.grace_days)).otherwise(left)
    limits = customers.select("FanID", F.coalesce(shifted, F.lit(NO_LIMIT)).alias("_limit"))
    in_time = (tx["FanID"] == limits["FanID"]) & (tx["TranDate"] < limits["_limit"])
    return exclude_logged(tx.join(limits, in_time, "left_semi"), log)


def dd_customers(
    tx: DataFrame,
    customers: DataFrame,
    pii: DataFrame,
    id_map: DataFrame,
    duplicates: DataFrame,
    post_areas: DataFrame,
) -> DataFrame:
    """Customers of the transactions with card id, date of birth and known post area."""
    theirs = restrict_dim(customers, tx, "FanID")
    ids = anti(id_map.select(F.col("CIN").alias("SourceUID"), "CINID"), duplicates, ["SourceUID"])
    areas = post_areas.select(F.trim(F.upper("PostAreaCode")).alias("UserPostcodeArea"))
    keyed = theirs.withColumn("UserPostcodeArea", F.trim(text_key("PostArea")))
    known = areas.withColumn("_area", F.col("UserPostcodeArea"))
    return (
        keyed.join(ids, "SourceUID")
        .join(pii.select("CustomerGUID", "DOB"), "CustomerGUID", "left")
        .join(known, "UserPostcodeArea", "left")
        .select(
            "CustomerGUID",
            "FanID",
            "SourceUID",
            "CINID",
            "DOB",
            F.col("_area").alias("UserPostcodeArea"),
            "DeactivatedDate",
        )
    )


def drop_max_id_duplicates(df: DataFrame) -> DataFrame:
    """Per customer with several rows, drop those with the highest card id.

    Two rows with the same highest id both go, as in the source.
    """
    highest = (
        df.groupBy("CustomerGUID")
        .agg(F.max("CINID").alias("CINID"), F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > 1)
    )
    return anti(df, highest, ["CustomerGUID", "CINID"])


def restrict_dim(dim: DataFrame, tx: DataFrame, key: str) -> DataFrame:
    """Dimension rows referenced by transactions, which are first reduced to distinct keys."""
    return semi(dim, tx.select(key).distinct(), [key])


def dd_feed(
    tx: DataFrame,
    customers: DataFrame,
    accounts: DataFrame,
    merchants: DataFrame,
    config: DirectDebitConfig,
    load_day: date,
) -> DataFrame:
    """The direct-debit feed, with the age band on the day of the transaction."""
    people = customers.select("FanID", "CINID", "DOB", "UserPostcodeArea")
    banks = accounts.select("BankAccountID", "BankAccountGUID")
    shops = merchants.select("ConsumerCombinationID_DD", "OIN", "BrandID")
    return (
        tx.join(people, "FanID")
        .join(banks, "BankAccountID")
        .join(shops, "ConsumerCombinationID_DD")
        .select(
            F.lit(config.publisher).alias("PublisherID"),
            "FileID",
            "RowNum",
            "BankAccountGUID",
            "CINID",
            "ConsumerCombinationID_DD",
            "OIN",
            "BrandID",
            "TranDate",
            "Amount",
            "UserPostcodeArea",
            band(age_in_years("DOB", "TranDate"), AGE_DETAILED).alias("CurrentAgeBandText"),
            F.lit("N").alias("UpdateType"),
            F.lit(None).cast("date").alias("UpdateDate"),
            F.lit(load_day).alias("LoadDate"),
        )
    )
