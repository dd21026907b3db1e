"""Queries over the customer profile, the customer feed and the pseudonymised customer table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cardloom.config import AffinityConfig
from cardloom.functions.keys import coded_label, postal_sector, postcode_key
from cardloom.operators import affinity, customer as cust
from cardloom.plans.quarantine import affinity_source
from cardloom.sources.buckets import BucketedState
from cardloom.sources.tables import staged, work_dir
from workload.registry import query
from workload.roles import Roles

AFFINITY = AffinityConfig(primary_clubs=(11, 12), secondary_clubs=(21, 22, 23), pseudonym_offset=77)
KNOWN = "balance > 0"


# The four age band schemes, written out here so that a wrong bound in the package shows.
AGE_NUMBER = """CASE WHEN {0} BETWEEN 18 AND 24 THEN 1 WHEN {0} BETWEEN 25 AND 29 THEN 2 WHEN {0} BETWEEN 30 AND 39 THEN 3
    WHEN {0} BETWEEN 40 AND 49 THEN 4 WHEN {0} BETWEEN 50 AND 59 THEN 5 WHEN {0} BETWEEN 60 AND 64 THEN 6 WHEN {0} >= 65 THEN 7
    ELSE 0 END"""
AGE_GROUP = """CASE WHEN {0} BETWEEN 18 AND 24 THEN '01. 18 to 24' WHEN {0} BETWEEN 25 AND 29 THEN '02. 25 to 29'
    WHEN {0} BETWEEN 30 AND 39 THEN '03. 30 to 39' WHEN {0} BETWEEN 40 AND 49 THEN '04. 40 to 49'
    WHEN {0} BETWEEN 50 AND 59 THEN '05. 50 to 59' WHEN {0} BETWEEN 60 AND 64 THEN '06. 60 to 64' WHEN {0} >= 65 THEN '07. 65+'
    ELSE '99. Unknown' END"""
AGE_INSIGHT = """CASE WHEN {0} BETWEEN 18 AND 24 THEN '01. 18 to 24' WHEN {0} BETWEEN 25 AND 34 THEN '02. 25 to 34'
    WHEN {0} BETWEEN 35 AND 44 THEN '03. 35 to 44' WHEN {0} BETWEEN 45 AND 54 THEN '04. 45 to 54'
    WHEN {0} BETWEEN 55 AND 64 THEN '05. 55 to 64' WHEN {0} >= 65 THEN '06. 65+' ELSE '99. Unknown' END"""
AGE_DETAILED = """CASE WHEN {0} BETWEEN 18 AND 24 THEN '01. 18 to 24' WHEN {0} BETWEEN 25 AND 34 THEN '02. 25 to 34'
    WHEN {0} BETWEEN 35 AND 44 THEN '03. 35 to 44' WHEN {0} BETWEEN 45 AND 54 THEN '04. 45 to 54'
    WHEN {0} BETWEEN 55 AND 64 THEN '05. 55 to 64' WHEN {0} BETWEEN 65 AND 74 THEN '06. 65 to 74' WHEN {0} >= 75 THEN '07. 75+'
    ELSE '99. Unknown' END"""


def all_bands_sql(column: str) -> str:
    return f"""{AGE_NUMBER.format(column)} AS AgeCurrentBandNumber, {AGE_GROUP.format(column)} AS AgeGroup,
        {AGE_INSIGHT.format(column)} AS Insight_AgeBand, {AGE_DETAILED.format(column)} AS HDI_AgeBand"""


@query(
    "age_bands_c1",
    f"""WITH aged AS (SELECT FanID, AgeCurrent FROM {{people}} UNION ALL SELECT p_partkey, p_size FROM {{part}})
        SELECT *, {all_bands_sql("AgeCurrent")} FROM aged""",
)
def _(r: Roles):
    parts = r.part.select(F.col("p_partkey").alias("FanID"), F.col("p_size").alias("AgeCurrent"))
    return cust.age_bands(r.people.select("FanID", "AgeCurrent").unionByName(parts))


PROFILE = f"""
    SELECT p.SourceUID AS CIN, i.CINID, Gender, d.DOB, p.PostCode, {{{{sector}}}} AS PostalSector, PostCodeDistrict, PostArea,
           {all_bands_sql("AgeCurrent")}, COALESCE(Region, 'Unknown') AS Region,
           COALESCE(m.CAMEO_CODE_GROUP || '-' || g.CAMEO_CODE_GROUP_Category, '99. Unknown') AS CAMEO_CODE_GRP,
           trim(a.acorncode2022, '"') AS acorncode2022, trim(a.acorncode2023, '"') AS acorncode2023,
           n.microcell_id, RegistrationDate, DeactivatedDate
    FROM {{people}} p JOIN {{id_map}} i ON i.CIN = p.SourceUID LEFT JOIN {{details}} d ON d.FanID = p.FanID
    LEFT JOIN {{acorn}} a ON replace(trim(upper(a.postcode), '" '), ' ', '') = replace(trim(upper(p.PostCode), '" '), ' ', '')
    LEFT JOIN {{cameo}} m ON upper(rtrim(m.postcode)) = upper(rtrim(p.PostCode))
    LEFT JOIN {{cameo_group}} g ON g.CAMEO_CODE_GROUP = m.CAMEO_CODE_GROUP
    LEFT JOIN {{cohort_now}} n ON n.CINID = i.CINID
    WHERE p.SourceUID NOT IN (SELECT SourceUID FROM {{duplicate_ids}} WHERE EndDate IS NULL)
      AND i.CINID NOT IN (SELECT cinid FROM {{excluded_ids}})"""
SECTOR = """CASE WHEN instr(p.PostCode, ' ') = 0 THEN p.PostCode || ' ' || substr(p.PostCode, 1, 1)
    ELSE split_part(p.PostCode, ' ', 1) || ' ' || substr(p.PostCode, instr(p.PostCode, ' ') + 1, 1) END"""


def profile(r: Roles, sector_from_postcode: bool = False):
    return cust.customer_profile(
        r.people,
        r.id_map,
        r.acorn,
        r.cameo,
        r.cameo_group,
        r.cohort_now,
        r.duplicate_ids,
        r.excluded_ids,
        details=r.details,
        sector_from_postcode=sector_from_postcode,
    )


@query("customer_profile_c2", PROFILE.replace("{{sector}}", "PostalSector"))
def _(r: Roles):
    return profile(r)


@query("customer_profile_detailed_c2", PROFILE.replace("{{sector}}", SECTOR))
def _(r: Roles):
    return profile(r, sector_from_postcode=True)


@query(
    "exclude_customers_c3",
    """SELECT SourceUID, k AS CINID FROM {people}
       WHERE SourceUID NOT IN (SELECT SourceUID FROM {duplicate_ids} WHERE EndDate IS NULL)
         AND k NOT IN (SELECT cinid FROM {excluded_ids})""",
)
def _(r: Roles):
    ids = r.people.select("SourceUID", F.col("k").alias("CINID"))
    return cust.exclude_customers(ids, r.duplicate_ids, r.excluded_ids)


@query(
    "exclude_customers_any_end_c3",
    "SELECT SourceUID, k AS CINID FROM {people} p ANTI JOIN {duplicate_ids} d ON d.SourceUID = p.SourceUID",
)
def _(r: Roles):
    ids = r.people.select("SourceUID", F.col("k").alias("CINID"))
    return cust.exclude_customers(ids, r.duplicate_ids, open_only=False, null_aware=False)


@query(
    "postcode_join_c4",
    """SELECT FanID, regexp_replace(regexp_replace(upper(PostCode), '^[" ]+|[" ]+$', '', 'g'), ' ', '', 'g') AS postcode_key,
              trim(acorncode2022, '"') AS acorncode2022, trim(acorncode2023, '"') AS acorncode2023
       FROM {people} LEFT JOIN (SELECT trim(postcode, '"') AS pc, acorncode2022, acorncode2023 FROM {acorn}) a
         ON pc = regexp_replace(regexp_replace(upper(PostCode), '^[" ]+|[" ]+$', '', 'g'), ' ', '', 'g')""",
)
def _(r: Roles):
    people = r.people.select("FanID", "PostCode")
    return cust.attach_acorn(people, r.acorn).select(
        "FanID", postcode_key("PostCode").alias("postcode_key"), "acorncode2022", "acorncode2023"
    )


@query(
    "coded_label_c5",
    """SELECT postcode, CASE WHEN m.CAMEO_CODE_GROUP IS NULL OR CAMEO_CODE_GROUP_Category IS NULL THEN '99. Unknown'
              ELSE concat(m.CAMEO_CODE_GROUP, '-', CAMEO_CODE_GROUP_Category) END AS label
       FROM {cameo} m LEFT JOIN {cameo_group} g ON g.CAMEO_CODE_GROUP = m.CAMEO_CODE_GROUP""",
)
def _(r: Roles):
    joined = r.cameo.join(r.cameo_group, "CAMEO_CODE_GROUP", "left")
    return joined.select("postcode", coded_label("CAMEO_CODE_GROUP", "CAMEO_CODE_GROUP_Category").alias("label"))


FEED = """SELECT DISTINCT i.CINID AS cinid, NULLIF(trim(Gender), '') AS gender, NULLIF(rtrim(PostalSector), '') AS postalsector,
           NULLIF(PostCodeDistrict, '') AS postcodedistrict, NULLIF(PostArea, '') AS postarea, NULLIF(Region, '') AS region,
           NULLIF(AgeCurrentBandNumber, 0) AS agecurrentbandnumber, AgeGroup AS agegroup, CAMEO_CODE_GRP AS cameo_code_grp,
           COALESCE(Insight_AgeBand, '99. Unknown') AS insight_ageband, HDI_AgeBand AS hdi_ageband,
           NULLIF(trim(acorncode2022), '') AS acorncode2022, NULLIF(trim(acorncode2023), '') AS acorncode2023,
           CASE WHEN p.CIN IS NULL OR DeactivatedDate IS NOT NULL THEN 0 ELSE 1 END AS inprogram,
           NULLIF(microcell_id, 0) AS microcell_id, NULLIF(RegistrationDate, DATE '1900-01-01') AS RegistrationDate,
           DeactivatedDate
        FROM {id_map} i LEFT JOIN profile p ON p.CIN = i.CIN"""


@query("customer_feed_c6", "WITH profile AS (" + PROFILE.replace("{{sector}}", "PostalSector") + ") " + FEED)
def _(r: Roles):
    return cust.customer_feed(r.id_map, profile(r))


@query(
    "customer_feed_detailed_c6",
    "WITH profile AS ("
    + PROFILE.replace("{{sector}}", SECTOR)
    + ") "
    + FEED.replace("SELECT DISTINCT", "SELECT DISTINCT NULLIF(p.PostCode, '') AS postcode,"),
)
def _(r: Roles):
    return cust.customer_feed(r.id_map, profile(r, sector_from_postcode=True), detailed=True)


@query("postal_sector_c7", "SELECT FanID, " + SECTOR + " AS sector FROM {people} p")
def _(r: Roles):
    return r.people.select("FanID", postal_sector("PostCode").alias("sector"))


PRIMARY = """
    SELECT FanID, CompositeID, CINID, ClubID, PostCodeDistrict AS PostcodeDistrict, SourceUID, CAST(rw AS INTEGER) AS rw,
           PostArea AS PostalArea
    FROM (SELECT c.*, i.CINID, row_number() OVER (PARTITION BY c.SourceUID ORDER BY ClubID, FanID) AS rw
          FROM {club_cards} c JOIN {id_map} i ON i.CIN = c.SourceUID
          WHERE ClubID IN (11, 12) AND CustomerGUID IN (SELECT CustomerGUID FROM {consents} WHERE AgreedTerms = 1)) ranked
    WHERE rw = 1"""
POPULATION = (
    PRIMARY
    + """ UNION ALL SELECT ID, CompositeID, NULL, ClubID, NULL, SourceUID, 1, NULL FROM {secondary_fans} WHERE ClubID IN (21, 22, 23)"""
)


def primary(r: Roles):
    return affinity.preferred_card(r.club_cards, r.id_map, r.consents, AFFINITY.primary_clubs)


@query("preferred_card_f1", PRIMARY)
def _(r: Roles):
    return primary(r)


@query("affinity_population_f2", POPULATION)
def _(r: Roles):
    return affinity.affinity_population(primary(r), r.secondary_fans, AFFINITY.secondary_clubs)


@query(
    "proxy_user_id_f3",
    "WITH population AS ("
    + POPULATION
    + ") SELECT FanID, SourceUID, sha256(concat(CAST(FanID + 77 AS VARCHAR), ',', SourceUID)) AS pseudonym FROM population",
)
def _(r: Roles):
    people = affinity.affinity_population(primary(r), r.secondary_fans, AFFINITY.secondary_clubs)
    named = affinity.proxy_user_id(people, AFFINITY.pseudonym_offset)
    return named.select("FanID", "SourceUID", F.lower(F.hex("ProxyUserID")).alias("pseudonym"))


MOVED = "CASE WHEN FanID % 3 = 0 THEN {0} || '*' WHEN FanID % 3 = 1 THEN NULL ELSE {0} END"


@query(
    "row_checksum_f4",
    "WITH population AS ("
    + POPULATION
    + f"""), earlier AS (SELECT FanID, PostcodeDistrict AS was, {MOVED.format("PostcodeDistrict")} AS now FROM population)
        SELECT FanID, was IS DISTINCT FROM now AS changed FROM earlier""",
)
def _(r: Roles):
    source = affinity_source(r.club_cards, r.id_map, r.consents, r.secondary_fans, AFFINITY)
    moved = source.withColumn("PostcodeDistrict", F.expr(MOVED.format("PostcodeDistrict")))
    again = affinity.row_checksums(moved.withColumnRenamed("Chksum", "before"))
    return again.select("FanID", (F.col("before") != F.col("Chksum")).alias("changed"))


STATE_SQL = f"""
    SELECT FanID, CompositeID, CINID, ClubID, {MOVED.format("PostcodeDistrict")} AS PostcodeDistrict, SourceUID, rw,
           PostalArea, 0 AS isNew FROM population WHERE ClubID IN (11, 21)"""


@query(
    "change_upsert_f5",
    "WITH population AS ("
    + POPULATION
    + "), state AS ("
    + STATE_SQL
    + """) SELECT s.FanID, s.CompositeID, s.CINID, s.ClubID, p.PostcodeDistrict, s.SourceUID, s.rw, p.PostalArea, s.isNew
           FROM state s JOIN population p USING (FanID)
           UNION ALL
           SELECT FanID, CompositeID, CINID, ClubID, PostcodeDistrict, SourceUID, rw, PostalArea, 1 FROM population p
           WHERE FanID NOT IN (SELECT FanID FROM state) AND NOT EXISTS (SELECT 1 FROM state s WHERE s.CINID = p.CINID)""",
)
def _(r: Roles):
    source = affinity_source(r.club_cards, r.id_map, r.consents, r.secondary_fans, AFFINITY)
    earlier = source.where(F.col("ClubID").isin(11, 21)).withColumns(
        {"PostcodeDistrict": F.expr(MOVED.format("PostcodeDistrict")), "isNew": F.lit(0)}
    )
    return affinity.upsert_changed(affinity.row_checksums(earlier), source).drop("Chksum", "ProxyUserID")


@query(
    "change_upsert_bucketed_f5",
    "WITH population AS ("
    + POPULATION
    + "), state AS ("
    + STATE_SQL
    + """) SELECT s.FanID, s.CompositeID, s.CINID, s.ClubID, p.PostcodeDistrict, s.SourceUID, s.rw, p.PostalArea, s.isNew
           FROM state s JOIN population p USING (FanID)
           UNION ALL
           SELECT FanID, CompositeID, CINID, ClubID, PostcodeDistrict, SourceUID, rw, PostalArea, 1 FROM population p
           WHERE FanID NOT IN (SELECT FanID FROM state) AND NOT EXISTS (SELECT 1 FROM state s WHERE s.CINID = p.CINID)""",
)
def _(r: Roles):
    source = affinity_source(r.club_cards, r.id_map, r.consents, r.secondary_fans, AFFINITY)
    earlier = source.where(F.col("ClubID").isin(11, 21)).withColumns(
        {"PostcodeDistrict": F.expr(MOVED.format("PostcodeDistrict")), "isNew": F.lit(0)}
    )
    before = affinity.row_checksums(earlier)
    name = f"customers-{uuid.uuid4().hex}"
    state = BucketedState(r.spark, f"{work_dir(r.spark)}/{name}", before.schema, ("FanID",), buckets=16)
    state.write(before, "before")
    affinity.upsert_changed_state(state, source, "after", lambda df, what: staged(df, what, name))
    return state.read().drop("Chksum", "ProxyUserID")
