"""Queries over the merchant dimension."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cardloom.config import MerchantScope, NarrativeRules
from cardloom.functions.keys import combo_id, combo_id_spaceless
from cardloom.operators import merchant as m
from cardloom.sources.buckets import BucketedState
from cardloom.sources.tables import staged, work_dir
from workload.registry import query
from workload.roles import Roles

SCOPE = MerchantScope(sector_groups=(3,), brands=(5, 17), mccs=(8, 12, 33))
RULES = NarrativeRules(
    excluded_exact=("RED%", "OLD ROD*", "hot bolt"),
    excluded_like=("%widget%",),
    included_mids=("4,PRO-1",),
    included_like=("%large%gear%", "blue%"),
    included_prefixed_mids=("MID7,SMA-2", "MID11,ECO-3"),
    included_narratives=("HOT RING", "SMALL PLATE"),
    included_narrative_mccs=(22, 26, 31, 36, 41),
)


@query(
    "clean_narratives_d1",
    """SELECT min(Narrative) AS Narrative, trim(regexp_replace(upper(min(Narrative)), '[^A-Z0-9]+', ' ', 'g')) AS NarrativeCleaned
       FROM {merchants} x WHERE trim(Narrative) <> ''
         AND upper(rtrim(Narrative)) NOT IN (SELECT upper(rtrim(Narrative)) FROM {narrative_cache})
       GROUP BY upper(rtrim(Narrative))""",
)
def _(r: Roles):
    return m.clean_narratives_incremental(r.merchants, r.narrative_cache)


@query(
    "clean_page_urls_d1",
    """SELECT min(url) AS Narrative, trim(regexp_replace(upper(min(url)), '[^A-Z0-9]+', ' ', 'g')) AS NarrativeCleaned
       FROM {pages} WHERE trim(url) <> ''
         AND upper(rtrim(url)) NOT IN (SELECT upper(rtrim(url)) FROM {pages} WHERE url LIKE 'https:%')
       GROUP BY upper(rtrim(url))""",
)
def _(r: Roles):
    urls = r.pages.withColumnRenamed("url", "Narrative").select("Narrative")
    known = urls.where("Narrative like 'https:%'").withColumn("NarrativeCleaned", F.lit("known"))
    return m.clean_narratives_incremental(urls, known)


POSTED = """
    FROM {merchants} c LEFT JOIN {merchant_postcode} p ON p.ConsumerCombinationID = c.ConsumerCombinationID
    LEFT JOIN {alternates} a ON a.ConsumerCombinationID = c.ConsumerCombinationID
    LEFT JOIN {alternate_locations} l ON l.ID = a.AlternateLocationID"""
FINAL = "COALESCE(NULLIF(l.PostCode, ''), p.PostCode)"
BASE = f"""
    SELECT c.ConsumerCombinationID, BrandID, LocationCountry, MCCID, IsUKSpend, COALESCE(p.PostCode, '') AS PostCode,
           COALESCE(p.LocationID, 0) AS LocationID, COALESCE(l.PostCode, '') AS AlternatePostCode,
           COALESCE(a.AlternateLocationID, 0) AS AlternateLocationID, replace(MID, ',', '') AS MID,
           n.NarrativeCleaned AS Narrative, {FINAL} AS FinalPostcode, OriginatorID
    {POSTED} LEFT JOIN {{narrative_cache}} n ON upper(rtrim(n.Narrative)) = upper(rtrim(c.Narrative))"""


def base(r: Roles):
    return m.merchant_base(r.merchants, r.merchant_postcode, r.alternates, r.alternate_locations, r.narrative_cache)


@query("merchant_base_d2", BASE)
def _(r: Roles):
    return base(r)


@query(
    "merchant_detail_d2",
    f"""SELECT c.ConsumerCombinationID, BrandMIDID, BrandID, replace(MID, ',', '') AS MID, replace(Narrative, ',', '') AS Narrative,
               LocationCountry, MCCID, OriginatorID, IsHighVariance, IsUKSpend, PaymentGatewayStatusID, IsCreditOrigin,
               {FINAL} AS Postcode {POSTED}""",
)
def _(r: Roles):
    return m.merchant_detail(r.merchants, r.merchant_postcode, r.alternates, r.alternate_locations)


SPACELESS = """replace(upper('MID' || MID || Narrative || CASE WHEN length(FinalPostcode) >= 2
    THEN substr(FinalPostcode, 1, length(FinalPostcode) - 2) ELSE '' END), ' ', '')"""
PACKED = "regexp_replace(FinalPostcode, '[^A-Za-z0-9]', '', 'g')"
COMBO = f"""upper('MID' || regexp_replace(MID, '[^A-Za-z0-9]', '', 'g') || Narrative
    || CASE WHEN length(FinalPostcode) > 2 THEN substr({PACKED}, 1, length({PACKED}) - 2) ELSE '' END)"""


@query(
    "combo_id_d3",
    f"WITH base AS ({BASE}) SELECT ConsumerCombinationID, {COMBO} AS ComboID, {SPACELESS} AS ComboIDSpaceless FROM base",
)
def _(r: Roles):
    parts = ("MID", "Narrative", "FinalPostcode")
    return base(r).select(
        "ConsumerCombinationID",
        combo_id(*parts).alias("ComboID"),
        combo_id_spaceless(*parts).alias("ComboIDSpaceless"),
    )


KEYED = f"""
    SELECT ConsumerCombinationID, BrandID, trim(LocationCountry) AS LocationCountry, b.MCCID, PostCode, MID, Narrative,
           PostCode AS rawPostcode, AlternatePostCode AS rawAlternatePostcode, MID AS rawMID, Narrative AS rawNarrative,
           FinalPostcode, {COMBO} AS ComboID,
           upper(sha256(concat(LocationCountry, Narrative, OriginatorID, MCC, MID))) AS ProxyMIDTupleID
    FROM base b JOIN {{mcc}} c ON c.MCCID = b.MCCID"""


@query("tuple_hash_d4", f"WITH base AS ({BASE}) {KEYED}")
def _(r: Roles):
    return m.merchant_keys(base(r), r.mcc)


@query(
    "merchant_upsert_d5",
    """SELECT t.* REPLACE (CASE WHEN s.BrandID <> t.BrandID THEN s.BrandID ELSE t.BrandID END AS BrandID)
       FROM {merchants_before} t LEFT JOIN {merchants} s USING (ConsumerCombinationID)
       UNION ALL BY NAME
       SELECT s.* REPLACE (replace(MID, ',', '') AS MID, replace(Narrative, ',', '') AS Narrative) FROM {merchants} s
       WHERE ConsumerCombinationID NOT IN (SELECT ConsumerCombinationID FROM {merchants_before})""",
)
def _(r: Roles):
    return m.upsert_merchants(r.merchants_before, r.merchants)


PATTERNS = """
    SELECT DISTINCT '%' || substr(Narrative, 2, 5) || '%' AS pattern FROM {merchants} WHERE length(Narrative) > 3
    UNION SELECT DISTINCT lower(substr(Narrative, 1, 6)) || '_%' FROM {merchants} UNION SELECT '%o%l%'"""


@query(
    "narrative_rule_index_d7",
    "WITH rules AS ("
    + PATTERNS
    + """) SELECT ConsumerCombinationID, count(*) AS rules, min(pattern) AS first_rule
           FROM (SELECT DISTINCT m.ConsumerCombinationID, r.pattern FROM {merchants} m JOIN rules r ON lower(m.Narrative) LIKE lower(r.pattern))
           GROUP BY ConsumerCombinationID""",
)
def _(r: Roles):
    name = F.col("Narrative")
    patterns = (
        r.merchants.where(F.length(name) > 3).select(F.concat(F.lit("%"), F.substring(name, 2, 5), F.lit("%")).alias("pattern"))
        .union(r.merchants.select(F.concat(F.lower(F.substring(name, 1, 6)), F.lit("_%"))))
        .union(r.spark.range(1).select(F.lit("%o%l%")))
        .distinct()
    )
    found = m.match_rules(r.merchants, patterns.withColumn("rule", F.col("pattern")), "Narrative", "ConsumerCombinationID")
    return found.groupBy("ConsumerCombinationID").agg(F.count(F.lit(1)).alias("rules"), F.min("rule").alias("first_rule"))


@query(
    "merchant_upsert_bucketed_d5",
    """SELECT t.* REPLACE (CASE WHEN s.BrandID <> t.BrandID THEN s.BrandID ELSE t.BrandID END AS BrandID)
       FROM {merchants_before} t LEFT JOIN {merchants} s USING (ConsumerCombinationID)
       UNION ALL BY NAME
       SELECT s.* REPLACE (replace(MID, ',', '') AS MID, replace(Narrative, ',', '') AS Narrative) FROM {merchants} s
       WHERE ConsumerCombinationID NOT IN (SELECT ConsumerCombinationID FROM {merchants_before})""",
)
def _(r: Roles):
    name = f"merchants-{uuid.uuid4().hex}"
    before = r.merchants_before
    state = BucketedState(r.spark, f"{work_dir(r.spark)}/{name}", before.schema, ("ConsumerCombinationID",), buckets=16)
    state.write(before, "before")
    m.upsert_merchants_state(state, r.merchants, "after", lambda df, what: staged(df, what, name))
    return state.read()


SCOPED = """
    SELECT c.* FROM {brands} b JOIN {sectors} s ON s.SectorID = b.SectorID JOIN {merchants} c ON c.BrandID = b.BrandID
    WHERE s.SectorGroupID = 3 OR b.BrandID IN (5, 17)
    UNION
    SELECT c.* FROM {merchants} c JOIN {mcc} l ON l.MCCID = c.MCCID WHERE l.MCCID IN (8, 12, 33)"""


def scoped(r: Roles):
    return m.merchant_scope(r.merchants, r.brands, r.sectors, r.mcc, SCOPE)


@query("merchant_scope_d6", SCOPED)
def _(r: Roles):
    return scoped(r)


RULED = """
    SELECT * FROM {merchants} WHERE
      (upper(rtrim(Narrative)) NOT IN ('RED%', 'OLD ROD*', 'HOT BOLT') AND Narrative NOT ILIKE '%widget%' AND trim(LocationCountry) = 'GB')
      OR MID = '4,PRO-1' OR Narrative ILIKE '%large%gear%' OR Narrative ILIKE 'blue%'
      OR 'MID' || MID IN ('MID7,SMA-2', 'MID11,ECO-3')
      OR (upper(trim(Narrative)) IN ('HOT RING', 'SMALL PLATE') AND MCCID IN (22, 26, 31, 36, 41))"""


@query("narrative_rules_d7", RULED)
def _(r: Roles):
    return m.narrative_rules(r.merchants, RULES)


@query(
    "combo_expand_d8",
    f"""WITH base AS ({BASE}), combos AS (SELECT ConsumerCombinationID, BrandID, trim(LocationCountry) AS LocationCountry, b.MCCID, MID,
            Narrative, {SPACELESS} AS comboid_generated FROM base b JOIN {{mcc}} c ON c.MCCID = b.MCCID),
        scope AS ({SCOPED}), kept AS ({RULED} INTERSECT SELECT * FROM scope)
        SELECT * FROM combos WHERE comboid_generated IN (
            SELECT comboid_generated FROM combos JOIN kept USING (ConsumerCombinationID))""",
)
def _(r: Roles):
    return m.expand_by_combo(m.narrative_rules(scoped(r), RULES), m.merchant_keys(base(r), r.mcc))
