"""Queries over the direct-debit dimensions and feed."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.config import DirectDebitConfig, RunContext
from cardloom.functions.bands import AGE_DETAILED, band
from cardloom.functions.compat import age_in_years
from cardloom.functions.keys import dd_oin_base64, dd_tuple_key
from cardloom.operators import direct_debit as dd
from cardloom.plans.direct_debit import DirectDebitTables, direct_debit_rows
from cardloom.sources.files import export_exact, exported_files
from cardloom.sources.tables import staged, work_dir
from workload.customers import AGE_DETAILED as DETAILED_SQL
from workload.registry import query
from workload.roles import AS_OF, Roles

CONFIG = DirectDebitConfig(cutover=date(2000, 1, 1), unbranded_brand=9)
TUPLE_KEY = "substr(upper(sha256(Narrative_RBS || CAST(OIN AS VARCHAR))), 3)"
# Two's complement of a 32-bit number as eight hex digits.
OIN64 = "base64(unhex(lpad(hex(CAST(CASE WHEN OIN < 0 THEN OIN + 4294967296 ELSE OIN END AS BIGINT)), 8, '0')))"


@query(
    "mask_brand_h1",
    """SELECT b.BrandID, COALESCE(m.BrandName, b.BrandName) AS Label, b.SectorID
       FROM {brands} b LEFT JOIN {brand_mask} m ON m.BrandID = b.BrandID""",
)
def _(r: Roles):
    named = dd.mask_brand(r.brands.withColumnRenamed("BrandName", "_name"), r.brand_mask, BrandName="_name")
    return named.select("BrandID", F.col("BrandName").alias("Label"), "SectorID")


@query(
    "brand_taxonomy_h2",
    """SELECT DISTINCT b.BrandID, COALESCE(m.BrandName, b.BrandName) AS BrandName, g.GroupName, s.SectorName
       FROM {dd_merchants} d JOIN {brands} b ON b.BrandID = d.BrandID JOIN {sectors} s ON s.SectorID = b.SectorID
       JOIN {sector_groups} g ON g.SectorGroupID = s.SectorGroupID LEFT JOIN {brand_mask} m ON m.BrandID = b.BrandID""",
)
def _(r: Roles):
    return dd.brand_taxonomy(r.dd_merchants, r.brands, r.sectors, r.sector_groups, r.brand_mask)


@query("dd_tuple_key_h3", f"SELECT ConsumerCombinationID_DD, {TUPLE_KEY} AS ProxyOINTupleID FROM {{dd_merchants}}")
def _(r: Roles):
    key = dd_tuple_key("Narrative_RBS", F.col("OIN").cast("string"))
    return r.dd_merchants.select("ConsumerCombinationID_DD", key.alias("ProxyOINTupleID"))


@query("dd_oin_base64_h4", f"SELECT ConsumerCombinationID_DD, {OIN64} AS ProxyOIN FROM {{dd_merchants}}")
def _(r: Roles):
    return r.dd_merchants.select("ConsumerCombinationID_DD", dd_oin_base64("OIN").alias("ProxyOIN"))


DETAILS = f"""
    SELECT DISTINCT {TUPLE_KEY} AS ProxyOINTupleID, {OIN64} AS ProxyOIN, d.BrandID, COALESCE(m.BrandName, b.BrandName) AS BrandName,
           COALESCE(m.MerchantNarrative, Narrative_RBS) AS MerchantNarrative
    FROM {{dd_merchants}} d JOIN {{brands}} b ON b.BrandID = d.BrandID LEFT JOIN {{brand_mask}} m ON m.BrandID = d.BrandID
    WHERE EXISTS (SELECT 1 FROM {{dd_tx}} t JOIN {{earlier_customers}} c ON c.FanID = t.FanID
                  WHERE t.ConsumerCombinationID_DD = d.ConsumerCombinationID_DD)"""


def details(r: Roles) -> DataFrame:
    return dd.dd_merchant_details(r.dd_merchants, r.brands, r.brand_mask, r.dd_tx, r.earlier_customers)


@query("dd_merchant_details_h5", DETAILS)
def _(r: Roles):
    return details(r)


@query(
    "unbranded_duplicates_h6",
    "WITH details AS ("
    + DETAILS
    + """) SELECT * FROM details WHERE BrandID <> 9 OR ProxyOINTupleID NOT IN (
           SELECT ProxyOINTupleID FROM details GROUP BY ProxyOINTupleID HAVING count(*) > 1)""",
)
def _(r: Roles):
    return dd.drop_unbranded_duplicates(details(r), "ProxyOINTupleID", CONFIG.unbranded_brand)


NAMED = """
    FROM {dd_merchants} d LEFT JOIN {brands} b ON b.BrandID = d.BrandID LEFT JOIN {brand_mask} m ON m.BrandID = b.BrandID"""


@query(
    "dd_merchants_h7",
    f"""SELECT DISTINCT {TUPLE_KEY} AS ProxyOINTupleID, OIN, b.BrandID, COALESCE(m.BrandName, b.BrandName) AS BrandName,
               COALESCE(m.MerchantNarrative, Narrative_RBS) AS Narrative {NAMED}""",
)
def _(r: Roles):
    return dd.dd_merchants(r.dd_merchants, r.brands, r.brand_mask)


@query(
    "dd_merchants_by_id_h7",
    f"""SELECT DISTINCT ConsumerCombinationID_DD, OIN, b.BrandID, COALESCE(m.BrandName, b.BrandName) AS BrandName,
               replace(COALESCE(m.MerchantNarrative, Narrative_RBS), ',', '') AS Narrative {NAMED}""",
)
def _(r: Roles):
    return dd.dd_merchants(r.dd_merchants, r.brands, r.brand_mask, keyed_by_id=True)


MAPPING = """
    WITH combined AS (
        SELECT i.CINID AS ProxyUserID, hex(e.ProxyUserID) AS NeonProxyUserID, b.BankAccountGUID AS ProxyAccountID
        FROM (SELECT DISTINCT FanID, BankAccountID FROM {dd_tx}) t JOIN {people} p ON p.FanID = t.FanID
        JOIN {id_map} i ON i.CIN = p.SourceUID LEFT JOIN {earlier_customers} e ON e.FanID = p.FanID
        JOIN {bank_accounts} b ON b.BankAccountID = t.BankAccountID
        UNION ALL
        SELECT i.CINID, hex(a.ProxyUserID), b.BankAccountGUID
        FROM {affinity_customers} a JOIN {id_map} i ON i.CIN = a.SourceUID LEFT JOIN {people} p ON p.FanID = a.FanID
        LEFT JOIN {cards} c ON c.CustomerGUID = p.CustomerGUID LEFT JOIN {bank_accounts} b ON b.BankAccountGUID = c.AccountGUID
        UNION ALL
        SELECT h.CINID, hex(e.ProxyUserID), h.BankAccountGUID FROM {historic_accounts} h LEFT JOIN {earlier_customers} e ON e.CINID = h.CINID
        UNION ALL SELECT cinid, neonproxyuserid, bankaccountguid FROM {id_overrides})
    SELECT DISTINCT * FROM (
        SELECT * FROM combined UNION ALL
        SELECT i.CINID, NULL, NULL FROM {people} p JOIN {id_map} i ON i.CIN = p.SourceUID
        WHERE p.SourceUID NOT IN (SELECT SourceUID FROM {duplicate_ids})
          AND i.CINID NOT IN (SELECT ProxyUserID FROM combined WHERE ProxyUserID IS NOT NULL)) u"""


def mapping(r: Roles) -> DataFrame:
    return dd.proxy_mapping(
        r.dd_tx,
        r.people,
        r.id_map,
        r.earlier_customers,
        r.affinity_customers,
        r.cards,
        r.bank_accounts,
        r.historic_accounts,
        r.id_overrides,
        r.duplicate_ids,
    )


@query("proxy_mapping_h8", MAPPING)
def _(r: Roles):
    return mapping(r)


@query(
    "export_file_count_h9",
    "WITH mapping AS (" + MAPPING + ") SELECT CAST(ceil(count(*) / 1000.0) AS BIGINT) AS filecount FROM mapping",
)
def _(r: Roles):
    return dd.export_file_count(mapping(r), rows_per_file=1000)


@query(
    "export_exact_files_h9",
    "WITH mapping AS ("
    + MAPPING
    + """), n AS (SELECT count(*) AS n FROM mapping)
       SELECT CAST(i AS INTEGER) AS file_id, CAST(least(700, n - 700 * i) AS BIGINT) AS rows, n AS read_back
       FROM n, range((n + 699) // 700) f(i)""",
)
def _(r: Roles):
    rows = mapping(r)
    target = export_exact(rows.repartition(7), f"{work_dir(r.spark)}/mapping-export-{uuid.uuid4().hex}", AS_OF.date(), rows_per_file=700)
    back = r.spark.read.schema(rows.schema).parquet(target).distinct().agg(F.count(F.lit(1)))
    return exported_files(r.spark, target).select("file_id", "rows", back.scalar().alias("read_back"))


TRANSACTIONS = """
    SELECT t.* FROM {dd_tx} t
    WHERE EXISTS (SELECT 1 FROM {people} p WHERE p.FanID = t.FanID AND t.TranDate < CASE
            WHEN p.DeactivatedDate IS NULL THEN DATE '9999-12-31'
            WHEN p.DeactivatedDate < DATE '2000-01-01' THEN p.DeactivatedDate ELSE p.DeactivatedDate - 90 END)
      AND NOT EXISTS (SELECT 1 FROM {dd_log} l WHERE l.FileID = t.FileID AND l.RowNum = t.RowNum)"""
PEOPLE = """
    SELECT p.CustomerGUID, p.FanID, p.SourceUID, i.CINID, g.DOB, upper(trim(a.PostAreaCode)) AS UserPostcodeArea, p.DeactivatedDate
    FROM {people} p LEFT JOIN {pii} g ON g.CustomerGUID = p.CustomerGUID JOIN {id_map} i ON i.CIN = p.SourceUID
         AND i.CIN NOT IN (SELECT SourceUID FROM {duplicate_ids})
    LEFT JOIN {post_areas} a ON upper(trim(a.PostAreaCode)) = upper(trim(p.PostArea))
    WHERE p.FanID IN (SELECT FanID FROM tx)"""


def transactions(r: Roles) -> DataFrame:
    return dd.dd_eligible(r.dd_tx, r.people, r.dd_log, CONFIG, prune_by="FileID")


def people(r: Roles) -> DataFrame:
    return dd.dd_customers(transactions(r), r.people, r.pii, r.id_map, r.duplicate_ids, r.post_areas)


@query("dd_eligible_h10", TRANSACTIONS)
def _(r: Roles):
    return transactions(r)


@query("dd_customers_h11", "WITH tx AS (" + TRANSACTIONS + ")" + PEOPLE)
def _(r: Roles):
    return people(r)


@query(
    "max_id_duplicates_h12",
    """WITH cards AS (SELECT concat('G', CAST(FLOOR(k / 3) AS BIGINT)) AS CustomerGUID, k - k % 2 AS CINID, FanID FROM {people})
       SELECT c.* FROM cards c JOIN (SELECT CustomerGUID, max(CINID) AS top, count(*) AS n FROM cards GROUP BY CustomerGUID) d
         ON d.CustomerGUID = c.CustomerGUID WHERE n = 1 OR CINID <> top""",
)
def _(r: Roles):
    shared = F.concat(F.lit("G"), F.floor(F.col("k") / 3).cast("string"))
    cards = r.people.select(shared.alias("CustomerGUID"), (F.col("k") - F.col("k") % 2).alias("CINID"), "FanID")
    return dd.drop_max_id_duplicates(cards)


@query(
    "restrict_accounts_h13",
    "WITH tx AS ("
    + TRANSACTIONS
    + ") SELECT * FROM {bank_accounts} WHERE BankAccountID IN (SELECT BankAccountID FROM tx)",
)
def _(r: Roles):
    return dd.restrict_dim(r.bank_accounts, transactions(r), "BankAccountID")


@query(
    "restrict_merchants_h13",
    "WITH tx AS ("
    + TRANSACTIONS
    + ") SELECT * FROM {dd_merchants} WHERE ConsumerCombinationID_DD IN (SELECT ConsumerCombinationID_DD FROM tx)",
)
def _(r: Roles):
    return dd.restrict_dim(r.dd_merchants, transactions(r), "ConsumerCombinationID_DD")


AGE = "date_diff('year', DOB, TranDate) - CASE WHEN strftime(TranDate, '%m%d') < strftime(DOB, '%m%d') THEN 1 ELSE 0 END"


@query(
    "age_at_h14",
    f"""SELECT FileID, RowNum, CAST({AGE} AS INTEGER) AS age, {DETAILED_SQL.format("age")} AS band
        FROM {{dd_tx}} JOIN {{details}} USING (FanID)""",
)
def _(r: Roles):
    aged = r.dd_tx.join(r.details, "FanID").withColumn("age", age_in_years("DOB", "TranDate"))
    return aged.select("FileID", "RowNum", "age", band("age", AGE_DETAILED).alias("band"))


@query(
    "dd_feed_h15",
    "WITH tx AS ("
    + TRANSACTIONS
    + "), cust AS ("
    + PEOPLE
    + f"""), kept AS (SELECT * FROM cust c WHERE NOT EXISTS (SELECT 1 FROM
               (SELECT CustomerGUID, max(CINID) AS CINID FROM cust GROUP BY CustomerGUID HAVING count(*) > 1) d
               WHERE d.CustomerGUID = c.CustomerGUID AND d.CINID = c.CINID)),
         aged AS (SELECT t.*, c.CINID, c.UserPostcodeArea, {AGE} AS age FROM tx t JOIN kept c USING (FanID))
         SELECT 1 AS PublisherID, FileID, RowNum, BankAccountGUID, CINID, m.ConsumerCombinationID_DD, OIN, BrandID, TranDate, Amount,
                UserPostcodeArea, {DETAILED_SQL.format("age")} AS CurrentAgeBandText, 'N' AS UpdateType,
                CAST(NULL AS DATE) AS UpdateDate, DATE '2001-08-02' AS LoadDate
         FROM aged a JOIN {{bank_accounts}} b ON b.BankAccountID = a.BankAccountID
         JOIN {{dd_merchants}} m ON m.ConsumerCombinationID_DD = a.ConsumerCombinationID_DD""",
)
def _(r: Roles):
    tables = DirectDebitTables(
        transactions=r.dd_tx,
        programme_transactions=r.dd_tx,
        row_log=r.dd_log,
        customers=r.people,
        pii=r.pii,
        id_map=r.id_map,
        duplicates=r.duplicate_ids,
        post_areas=r.post_areas,
        accounts=r.bank_accounts,
        merchants=r.dd_merchants,
        brands=r.brands,
        sectors=r.sectors,
        sector_groups=r.sector_groups,
        taxonomy_mask=r.brand_mask,
        merchant_mask=r.brand_mask,
        earlier_customers=r.earlier_customers,
        affinity=r.affinity_customers,
        cards=r.cards,
        historic_mapping=r.historic_accounts,
        mapping_overrides=r.id_overrides,
    )
    # As in a run: written once, since the customers and the feed both ask for them.
    tx = staged(transactions(r), "dd-tx", f"feed-{uuid.uuid4().hex}")
    return direct_debit_rows(tables, tx, CONFIG, RunContext("check", AS_OF))
