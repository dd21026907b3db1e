"""Feed tables ("roles") derived from the driver's tables.

A role is one SELECT that Spark and DuckDB both understand, so the queries and the
oracles start from the same data; what is computed from a role is written twice,
once with the operators and once as plain SQL.  Roles only rename and derive
columns, or split a table by date or status.  ``{name}`` refers to a table or to
another role; ``<sha:x>`` is the SHA-256 hex of ``x`` in either dialect.
"""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cardloom.sources.tables import read_table

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

AS_OF = datetime(2001, 8, 2, 3, 0, 0)
EVENTS_FROM = date(2024, 1, 5)

_LETTER = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', c_nationkey + 1, 1)"
_AREA = f"concat({_LETTER}, 'X')"
_DISTRICT = f"concat({_AREA}, CAST(CAST(FLOOR(c_custkey / 200) AS BIGINT) + 1 AS STRING))"
_POSTCODE = f"concat({_DISTRICT}, ' ', CAST(c_custkey % 9 + 1 AS STRING), 'AB')"
_PACKED = f"concat({_DISTRICT}, CAST(c_custkey % 9 + 1 AS STRING), 'AB')"
_ROW = "(l_partkey * 1000000000 + l_suppkey) * 10 + l_linenumber"
_BRAND = "CAST(substr(p_brand, 7) AS INT)"
_HOUSE = "CAST(c_custkey % 40 + 1 AS STRING)"
_BORN = (
    "CASE WHEN c_custkey % 97 = 0 THEN DATE '1960-02-29' ELSE CAST(concat(CAST(1920 + c_custkey % 90 AS STRING), '-',"
    " lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0'), '-', lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0')) AS DATE) END"
)

ROLES: dict[str, str] = {
    # --- card transactions -------------------------------------------------
    "card_tx": f"""
        SELECT l_orderkey AS FileID, {_ROW} AS RowNum, l_partkey AS ConsumerCombinationID,
               CAST(l_quantity AS INT) % 11 AS CardholderPresentData, CAST(l_shipdate AS DATE) AS TranDate,
               o_custkey AS CINID, CAST(l_quantity AS DECIMAL(18,2)) AS Amount,
               CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END AS IsOnline,
               CAST(l_suppkey % 5 AS INT) AS InputModeID, l_returnflag AS flag, l_linestatus AS kind
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "debit_history": """
        SELECT FileID, RowNum, ConsumerCombinationID, CardholderPresentData, TranDate, CINID, Amount, IsOnline, InputModeID
        FROM {card_tx} WHERE kind = 'F'""",
    "credit_history": """
        SELECT FileID, RowNum, ConsumerCombinationID, CardholderPresentData, TranDate, CINID, Amount, IsOnline
        FROM {card_tx} WHERE kind = 'O'""",
    "debit_holding": """
        SELECT FileID, RowNum, ConsumerCombinationID, CardholderPresentData, TranDate, CINID, Amount, IsOnline, InputModeID
        FROM {card_tx} WHERE kind = 'F' AND TranDate >= DATE '2000-01-01'""",
    "credit_holding": """
        SELECT FileID, RowNum, ConsumerCombinationID, CardholderPresentData, TranDate, CINID, Amount, IsOnline, InputModeID
        FROM {card_tx} WHERE kind = 'O' AND TranDate >= DATE '2000-01-01'""",
    "staged_before": """
        SELECT FileID, RowNum FROM {card_tx} WHERE TranDate < DATE '2000-04-01' AND flag <> 'N'""",
    "row_log": """
        SELECT FileID, RowNum FROM {card_tx} WHERE TranDate < DATE '2000-06-01' AND flag = 'A'""",
    "row_log_detailed": """
        SELECT FileID, RowNum FROM {card_tx} WHERE TranDate < DATE '2000-09-01' AND flag = 'N'""",
    "extra_backfill": """
        SELECT FileID, RowNum, ConsumerCombinationID, CardholderPresentData, TranDate, CINID, Amount, IsOnline,
               CASE WHEN kind = 'F' THEN 1 ELSE 2 END AS PaymentTypeID
        FROM {card_tx} WHERE TranDate >= DATE '1999-06-01'""",
    "tran_time": f"""
        SELECT l_orderkey AS FileID, {_ROW} AS RowNum,
               concat(lpad(CAST(l_suppkey % 24 AS STRING), 2, '0'), ':', lpad(CAST(l_partkey % 60 AS STRING), 2, '0'),
                      ':', lpad(CAST(l_orderkey % 60 AS STRING), 2, '0')) AS TranTime
        FROM {{lineitem}} WHERE l_returnflag <> 'N'""",
    "load_dates": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS LoadDate FROM {orders}",
    # --- customers ----------------------------------------------------------
    "people": f"""
        SELECT c_custkey + 5000 AS FanID, concat('guid-', CAST(c_custkey AS STRING)) AS CustomerGUID,
               concat('S', CAST(c_custkey AS STRING)) AS SourceUID, c_custkey * 10 AS CompositeID,
               CASE c_mktsegment WHEN 'BUILDING' THEN 11 WHEN 'HOUSEHOLD' THEN 12 WHEN 'MACHINERY' THEN 11 ELSE 31 END AS ClubID,
               CASE c_nationkey % 3 WHEN 0 THEN ' M ' WHEN 1 THEN 'F' ELSE '  ' END AS Gender,
               CASE c_custkey % 7 WHEN 0 THEN lower({_POSTCODE}) WHEN 1 THEN {_PACKED}
                    WHEN 2 THEN concat('"', {_POSTCODE}, '"') WHEN 3 THEN '' WHEN 4 THEN concat({_POSTCODE}, ' ')
                    ELSE {_POSTCODE} END AS PostCode,
               concat({_DISTRICT}, ' ', CAST(c_custkey % 9 + 1 AS STRING)) AS PostalSector,
               {_DISTRICT} AS PostCodeDistrict, {_AREA} AS PostArea,
               CASE WHEN c_nationkey < 20 THEN concat('Region ', CAST(c_nationkey % 5 AS STRING)) END AS Region,
               CASE WHEN c_acctbal < -800 THEN NULL ELSE CAST(FLOOR(c_acctbal / 110) AS INT) END AS AgeCurrent,
               CASE WHEN c_custkey % 50 = 0 THEN DATE '1900-01-01' WHEN c_acctbal > 9000 THEN DATE '2001-07-15'
                    WHEN c_acctbal > 8900 THEN DATE '2001-07-02'
                    ELSE CAST(concat('199', CAST(c_custkey % 10 AS STRING), '-03-15') AS DATE) END AS RegistrationDate,
               CASE WHEN c_acctbal >= 0 AND c_acctbal < 1500 THEN DATE '2001-05-01'
                    WHEN c_acctbal >= 1500 AND c_acctbal < 2000 THEN DATE '1998-06-30' END AS DeactivatedDate,
               c_acctbal > -500 AS CurrentlyActive, c_custkey AS k, c_acctbal AS balance, c_mktsegment AS segment
        FROM {{customer}}""",
    "id_map": "SELECT SourceUID AS CIN, k AS CINID FROM {people}",
    "details": f"""
        SELECT c_custkey + 5000 AS FanID, concat('S', CAST(c_custkey AS STRING)) AS SourceUID, {_BORN} AS DOB,
               {_POSTCODE} AS PostCode
        FROM {{customer}}""",
    "duplicate_ids": """
        SELECT SourceUID, CASE WHEN k % 2 = 0 THEN DATE '2001-01-01' END AS EndDate
        FROM {people} WHERE balance > 9500""",
    "excluded_ids": "SELECT k AS cinid FROM {people} WHERE balance > 9000 AND balance < 9100",
    "acorn": f"""
        SELECT DISTINCT concat('"', {_PACKED}, '"') AS postcode,
               concat('"', CAST(c_nationkey % 6 AS STRING), '.A"') AS acorncode2022,
               CASE WHEN c_custkey % 9 = 4 THEN ' ' ELSE concat('"', CAST(c_custkey % 9 AS STRING), '.B"') END AS acorncode2023
        FROM {{customer}} WHERE c_nationkey <> 7""",
    "cameo": f"""
        SELECT DISTINCT {_POSTCODE} AS postcode,
               CASE WHEN c_custkey % 9 = 2 THEN NULL ELSE CAST((c_nationkey + c_custkey % 9) % 25 AS STRING) END AS CAMEO_CODE_GROUP
        FROM {{customer}} WHERE c_nationkey <> 3""",
    "cameo_group": """
        SELECT CAST(n_nationkey AS STRING) AS CAMEO_CODE_GROUP, n_name AS CAMEO_CODE_GROUP_Category
        FROM {nation} WHERE n_nationkey <> 5""",
    "cohort_now": "SELECT k AS CINID, CAST(k % 30 AS INT) AS microcell_id FROM {people} WHERE ClubID = 11",
    "archive": "SELECT k AS cinid FROM {people} WHERE balance < 7000",
    "programme": """
        SELECT k AS cinid, CASE WHEN DeactivatedDate IS NULL THEN 1 ELSE 0 END AS inprogram, RegistrationDate,
               CASE WHEN balance > 5000 THEN '05. 55 to 64' ELSE '01. 18 to 24' END AS insight_ageband
        FROM {people}""",
    # --- merchants ----------------------------------------------------------
    "merchants": f"""
        SELECT p_partkey AS ConsumerCombinationID, p_size AS BrandMIDID, {_BRAND} AS BrandID,
               concat(CAST({_BRAND} AS STRING), ',', substr(p_type, 1, 3), '-', CAST(p_size % 4 AS STRING)) AS MID,
               CASE WHEN p_size = 50 THEN NULL WHEN p_size = 49 THEN '  ' WHEN p_size % 5 = 0 THEN concat(upper(p_name), '*')
                    WHEN p_size % 5 = 1 THEN concat(p_name, '  ') WHEN p_size % 5 = 3 THEN concat(p_name, ', ', p_type)
                    ELSE p_name END AS Narrative,
               CASE WHEN p_type = 'PROMO' THEN 'FR' WHEN p_size % 2 = 0 THEN ' GB ' ELSE 'GB' END AS LocationCountry,
               p_size AS MCCID, CASE WHEN p_size <> 7 THEN concat('O', CAST({_BRAND} AS STRING)) END AS OriginatorID,
               p_size > 25 AS IsHighVariance, p_type <> 'PROMO' AS IsUKSpend, p_size % 3 AS PaymentGatewayStatusID,
               p_size % 2 = 0 AS IsCreditOrigin
        FROM {{part}}""",
    "merchants_before": """
        SELECT ConsumerCombinationID, BrandMIDID,
               CASE WHEN MCCID = 9 THEN NULL WHEN MCCID % 10 = 4 THEN BrandID + 100 ELSE BrandID END AS BrandID, MID, Narrative,
               LocationCountry, MCCID, OriginatorID, IsHighVariance, IsUKSpend, PaymentGatewayStatusID, IsCreditOrigin
        FROM {merchants} WHERE IsUKSpend""",
    "merchant_postcode": f"""
        SELECT p_partkey AS ConsumerCombinationID, CAST(p_partkey % 97 + 1 AS INT) AS LocationID,
               CASE p_size % 6 WHEN 0 THEN 'A' WHEN 1 THEN 'AB' WHEN 2 THEN 'AB1' WHEN 3 THEN ''
                    ELSE concat('ab', CAST({_BRAND} AS STRING), ' 1CD') END AS PostCode
        FROM {{part}} WHERE p_size <= 40""",
    "alternates": """
        SELECT p_partkey AS ConsumerCombinationID, p_size AS AlternateLocationID
        FROM {part} WHERE p_type = 'SMALL'""",
    "alternate_locations": """
        SELECT n_nationkey AS ID,
               CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE concat('ZZ', CAST(n_nationkey AS STRING), ' 9XY') END AS PostCode
        FROM {nation}""",
    "narrative_cache": """
        SELECT min(Narrative) AS Narrative, upper(min(trim(Narrative))) AS NarrativeCleaned
        FROM {merchants} WHERE Narrative NOT LIKE '%*' AND rtrim(Narrative) <> '' GROUP BY upper(rtrim(Narrative))""",
    "mcc": """
        SELECT DISTINCT p_size AS MCCID, CAST(5000 + p_size AS STRING) AS MCC FROM {part} WHERE p_size <= 45""",
    "brands": f"""
        SELECT DISTINCT {_BRAND} AS BrandID, p_brand AS BrandName, {_BRAND} % 8 AS SectorID
        FROM {{part}} WHERE p_brand <> 'Brand#25'""",
    "sectors": "SELECT n_nationkey AS SectorID, n_name AS SectorName, n_regionkey AS SectorGroupID FROM {nation}",
    "sector_groups": "SELECT r_regionkey AS SectorGroupID, r_name AS GroupName FROM {region}",
    "periods": f"""
        SELECT {_BRAND} AS BrandID, CAST(p_size AS DECIMAL(18,2)) AS Amount,
               CASE WHEN p_type = 'PROMO' THEN DATE '1997-03-01' ELSE DATE '1999-06-15' END AS startdate,
               CASE WHEN p_type = 'PROMO' THEN DATE '2000-02-29' END AS enddate
        FROM {{part}} WHERE p_type IN ('PROMO', 'LARGE') GROUP BY {_BRAND}, p_size, p_type""",
    # --- quarantine -----------------------------------------------------------
    "pending": f"""
        SELECT l_orderkey AS FileID, {_ROW} AS RowNum, o_custkey AS CINID, CAST(l_shipdate AS DATE) AS TranDate,
               CASE WHEN l_suppkey % 3 = 0 THEN concat(CAST(l_suppkey AS STRING), ',') ELSE CAST(l_suppkey AS STRING) END AS MID,
               CAST(l_quantity AS INT) AS MCCID, concat(o_orderpriority, ',', l_returnflag) AS Narrative,
               CASE WHEN l_discount > 0.05 THEN 'GB' ELSE 'IE' END AS LocationCountry,
               concat('R', CAST(l_suppkey % 10 AS STRING)) AS OriginatorID,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS Amount, CAST(l_quantity AS INT) % 11 AS CardholderPresentData,
               CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS PaymentTypeID,
               l_suppkey AS LocationID, l_linestatus AS kind
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P'""",
    "pending_debit": """
        SELECT FileID, RowNum, CINID, TranDate, MID, MCCID, Narrative, LocationCountry, OriginatorID, Amount,
               CardholderPresentData, PaymentTypeID, LocationID FROM {pending} WHERE kind = 'F'""",
    "pending_credit": """
        SELECT FileID, RowNum, CINID, TranDate, MID, MCCID, Narrative, LocationCountry, OriginatorID AS OriginatorReference,
               Amount, CardholderPresentData AS CardholderPresentMc, PaymentTypeID, LocationID
        FROM {pending} WHERE kind = 'O'""",
    "quarantine_log": "SELECT FileID, RowNum FROM {pending} WHERE TranDate < DATE '1997-01-01'",
    "inbound_times": "SELECT FileID, RowNum, TranTime AS TransactionTime FROM {tran_time}",
    "affinity_customers": """
        SELECT FanID, CAST(SourceUID AS BINARY) AS ProxyUserID, CompositeID, k AS CINID, ClubID, PostCodeDistrict AS PostcodeDistrict,
               SourceUID, CASE WHEN k % 10 = 3 THEN 2 ELSE 1 END AS rw, PostArea AS PostalArea
        FROM {people} WHERE ClubID <> 31""",
    "locations": "SELECT s_suppkey AS LocationID, s_name AS LocationAddress FROM {supplier} WHERE s_nationkey <> 4",
    "merchant_zips": """
        SELECT CAST(s_suppkey AS STRING) AS merchantid, concat('Z', CAST(s_nationkey AS STRING)) AS merchantzip
        FROM {supplier} WHERE s_acctbal > 1000""",
    "duplicate_cins": "SELECT SourceUID AS CIN, FanID FROM {people} WHERE balance > 9300",
    # --- pseudonyms -----------------------------------------------------------
    "club_cards": """
        SELECT FanID, CustomerGUID, concat('S', CAST(k - k % 2 AS STRING)) AS SourceUID, CompositeID, ClubID,
               PostCodeDistrict, PostArea, k
        FROM {people}""",
    "consents": """
        SELECT concat('guid-', CAST(o_custkey AS STRING)) AS CustomerGUID,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS AgreedTerms FROM {orders}""",
    "secondary_fans": """
        SELECT s_suppkey + 9000000 AS ID, s_suppkey * 10 AS CompositeID,
               CASE s_nationkey % 4 WHEN 0 THEN 21 WHEN 1 THEN 22 WHEN 2 THEN 23 ELSE 99 END AS ClubID,
               concat('N', CAST(s_suppkey AS STRING)) AS SourceUID FROM {supplier}""",
    # --- addresses ------------------------------------------------------------
    "pii": f"""
        SELECT c_custkey + 5000 AS FanID, concat('guid-', CAST(c_custkey AS STRING)) AS CustomerGUID,
               concat('S', CAST(c_custkey AS STRING)) AS SourceUID,
               CASE c_custkey % 8 WHEN 0 THEN concat('Flat ', CAST(c_custkey % 5 AS STRING)) WHEN 1 THEN concat({_HOUSE}, ' High St')
                    WHEN 2 THEN concat({_HOUSE}, ' High St') WHEN 3 THEN 'garden flat' WHEN 4 THEN 'Upper Floor'
                    WHEN 5 THEN 'Rose Cottage' WHEN 6 THEN 'Garden Flat' ELSE 'PO Box' END AS Address1,
               CASE c_custkey % 8 WHEN 0 THEN concat({_HOUSE}, ' High St') WHEN 1 THEN concat('Flat ', CAST(c_custkey % 5 AS STRING))
                    WHEN 3 THEN concat({_HOUSE}, ' High St') WHEN 4 THEN concat({_HOUSE}, ' High St')
                    WHEN 5 THEN NULL ELSE '' END AS Address2,
               {_POSTCODE} AS PostCode, {_BORN} AS DOB
        FROM {{customer}}""",
    "paf": f"""
        SELECT {_POSTCODE} AS Postcode,
               CASE WHEN o_orderstatus <> 'P' THEN {_HOUSE} ELSE '' END AS BuildingNumber,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 5 AS STRING) ELSE '' END AS SubBuildingNumber,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'Garden Flat' WHEN o_orderpriority = '2-HIGH' THEN NULL
                    WHEN o_orderstatus = 'F' THEN concat('FLAT ', CAST(o_orderkey % 5 AS STRING)) ELSE '' END AS SubBuildingName,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'Rose Cottage' ELSE '' END AS BuildingName
        FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey""",
    "paf_text": """
        SELECT DISTINCT upper(replace(concat('"', SubBuildingName, '","', CASE WHEN BuildingNumber <> '' THEN BuildingNumber
                     ELSE BuildingName END, '","', Postcode, '"'), ' ', '')) AS line, Postcode
        FROM {paf} WHERE SubBuildingName IS NOT NULL""",
    "cohort_addresses": """
        SELECT upper(<sha:line>) AS hashed_address, substr(Postcode, 1, length(Postcode) - 2) AS postcode_sector,
               CAST(length(line) % 7 AS INT) AS cohort_id FROM {paf_text}
        UNION ALL
        SELECT upper(<sha:line>) AS hashed_address, substr(Postcode, 1, length(Postcode) - 2) AS postcode_sector,
               CAST(length(line) % 7 + 3 AS INT) AS cohort_id FROM {paf_text} WHERE length(line) % 2 = 0""",
    "cohort_state": """
        SELECT CASE WHEN segment = 'HOUSEHOLD' THEN FanID + CAST(k % 3 AS BIGINT) ELSE FanID END AS FanID,
               CASE WHEN segment = 'HOUSEHOLD' THEN k - k % 2 ELSE k END AS CINID,
               CASE WHEN segment = 'BUILDING' THEN -1 ELSE CAST(k % 6 AS INT) END AS microcell_id,
               CAST(NULL AS STRING) AS HashedAddress, CAST(NULL AS STRING) AS UnhashedAddress,
               CASE WHEN k % 4 = 0 THEN DATE '2001-05-01' ELSE DATE '2001-06-01' END AS loadDay, 1 AS isCurrentCohort
        FROM {people} WHERE segment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY')""",
    "cohort_defaults": f"""
        SELECT DISTINCT {_POSTCODE} AS Postcode_Trim, CAST(100 + c_custkey % 4 AS INT) AS cohort_ID FROM {{customer}}
        WHERE c_nationkey <> 6""",
    "address_events": """
        SELECT concat('guid-', CAST(user_id AS STRING)) AS CustomerGUID, concat(CAST(event_id % 50 AS STRING), ' ', event_type) AS CustomerAddress1,
               props AS CustomerAddress2, CAST(NULL AS STRING) AS CustomerAddress3,
               CASE WHEN value < 3 THEN 'AB1' WHEN value < 8 THEN ' AB12C ' ELSE 'AB12 3CD' END AS PostCode,
               CASE WHEN event_type = 'signup' AND value > 60 THEN NULL ELSE CAST(ts AS DATE) END AS UpdatedAt,
               ts AS LoadDate, event_id
        FROM {events}""",
    "external_ids": """
        SELECT CustomerGUID, SourceUID AS ExternalID,
               CASE segment WHEN 'BUILDING' THEN 'alpha' WHEN 'HOUSEHOLD' THEN 'beta' WHEN 'MACHINERY' THEN 'gamma' ELSE 'other' END
                   AS ExternalIDSource
        FROM {people}""",
    # --- direct debit -----------------------------------------------------------
    "dd_tx": f"""
        SELECT l_orderkey AS FileID, {_ROW} AS RowNum, o_custkey * 3 + o_orderkey % 3 AS BankAccountID, o_custkey + 5000 AS FanID,
               l_partkey AS ConsumerCombinationID_DD, CAST(l_shipdate AS DATE) AS TranDate,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS Amount
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "dd_log": "SELECT FileID, RowNum FROM {dd_tx} WHERE TranDate < DATE '1998-01-01'",
    "dd_merchants": f"""
        SELECT p_partkey AS ConsumerCombinationID_DD, CASE WHEN p_size = 1 THEN -p_size ELSE p_size * 1000 END AS OIN,
               concat(p_name, ',') AS Narrative_RBS, {_BRAND} AS BrandID FROM {{part}}""",
    "brand_mask": """
        SELECT n_nationkey AS BrandID, concat('Group ', CAST(n_regionkey AS STRING)) AS BrandName,
               concat('Group, ', CAST(n_regionkey AS STRING)) AS MerchantNarrative
        FROM {nation} WHERE n_nationkey > 15""",
    "bank_accounts": """
        SELECT DISTINCT o_custkey * 3 + o_orderkey % 3 AS BankAccountID,
               concat('acc-', CAST(o_custkey * 3 + o_orderkey % 3 AS STRING)) AS BankAccountGUID
        FROM {orders} WHERE o_orderstatus <> 'O'""",
    "cards": """
        SELECT concat('guid-', CAST(o_custkey AS STRING)) AS CustomerGUID,
               concat('acc-', CAST(o_custkey * 3 + o_orderkey % 3 AS STRING)) AS AccountGUID
        FROM {orders} WHERE o_orderpriority = '2-HIGH'""",
    "historic_accounts": """
        SELECT k AS CINID, concat('old-', CAST(k AS STRING)) AS BankAccountGUID FROM {people} WHERE balance > 7000""",
    "earlier_customers": """
        SELECT FanID, k AS CINID, CAST(concat('P', SourceUID) AS BINARY) AS ProxyUserID FROM {people} WHERE balance > 4000""",
    "id_overrides": """
        SELECT CAST(r_regionkey AS BIGINT) AS cinid, upper(r_name) AS neonproxyuserid, concat('fix-', r_name) AS bankaccountguid
        FROM {region}""",
    "post_areas": """
        SELECT concat(' ', lower(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', n_nationkey + 1, 1)), 'x ') AS PostAreaCode
        FROM {nation} WHERE n_nationkey < 18""",
    # --- run logs -----------------------------------------------------------------
    "run_lines": """
        SELECT user_id * 100 + day(ts) AS RunID, event_id AS LogID,
               CASE WHEN event_type = 'view' AND value > 60 THEN NULL
                    WHEN event_type = 'error' AND value > 40 THEN concat('error: ', props)
                    WHEN event_type = 'click' AND value > 150 THEN 'TRACEBACK (most recent call last)'
                    WHEN event_type = 'signup' THEN 'ErrorX' WHEN event_type = 'purchase' AND value > 90 THEN 'last Error'
                    ELSE concat(event_type, ' done') END AS Msg
        FROM {events}""",
}

_REF = re.compile(r"\{(\w+)\}")


def _sha(sql: str, spark: bool) -> str:
    return re.sub(r"<sha:([^>]+)>", r"sha2(\1, 256)" if spark else r"sha256(\1)", sql)


_SCHEMAS: dict[str, StructType] = {}


def read_driver_table(spark: SparkSession, path: str) -> DataFrame:
    """A driver table; its footer is read for the schema once per process."""
    frame = read_table(spark, path, _SCHEMAS.get(path))
    _SCHEMAS[path] = frame.schema
    return frame


class Roles:
    """The roles of one data directory as DataFrames, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            if name in TABLES:
                frame = read_driver_table(self.spark, f"{self.sf_dir}/{name}.parquet")
            else:
                sql = _sha(ROLES[name], spark=True)
                frame = self.spark.sql(sql, **{ref: getattr(self, ref) for ref in set(_REF.findall(sql))})
            self._frames[name] = frame
        return self._frames[name]


def oracle(sql: str) -> str:
    """DuckDB text of a query over roles: the roles it needs become CTEs in front."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for ref in _REF.findall(text):
            if ref not in TABLES and ref not in ordered:
                need(ROLES[ref])
                ordered.append(ref)

    need(sql)
    body = _sha(_REF.sub(r"\1", sql), spark=False).strip()
    ctes = [f"{name} AS ({_sha(_REF.sub(r'\1', ROLES[name]), spark=False).strip()})" for name in ordered]
    if body.upper().startswith("WITH "):
        body = body[5:]
        return "WITH " + ",\n".join(ctes) + (",\n" if ctes else "") + body
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body
