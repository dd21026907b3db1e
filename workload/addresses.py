"""Queries over address matching, cohort state and address history."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.config import RunContext
from cardloom.operators import address as a
from cardloom.operators import history as h
from cardloom.plans.dimensions import AddressTables, address_state, daily_address_history, run_address_history_daily
from cardloom.sources.tables import staged, work_dir
from workload.registry import query
from workload.roles import AS_OF, EVENTS_FROM, Roles

CANDIDATES = """
    SELECT p.FanID, p.PostCode, p.PostalSector, i.Address1, i.Address2,
           regexp_replace(i.Address1, '[^0-9]', '', 'g') AS AddressOneNumber,
           regexp_replace(i.Address2, '[^0-9]', '', 'g') AS AddressTwoNumber
    FROM {people} p JOIN {pii} i ON i.FanID = p.FanID
    WHERE PostalSector IN (SELECT postcode_sector FROM {cohort_addresses})"""

# One SELECT per rule; a rule runs on the candidates the rules before it left over.
_RULES = (
    "f.BuildingNumber = c.AddressTwoNumber AND f.SubBuildingNumber = c.AddressOneNumber AND c.AddressTwoNumber <> ''",
    "f.BuildingNumber = c.AddressOneNumber AND f.SubBuildingNumber = c.AddressTwoNumber AND c.AddressTwoNumber <> ''",
    "f.BuildingNumber = c.AddressOneNumber AND c.AddressOneNumber <> ''",
    "f.BuildingNumber = c.AddressTwoNumber AND upper(c.Address1) = upper(f.SubBuildingName) AND c.AddressTwoNumber <> ''",
    "f.BuildingNumber = c.AddressTwoNumber AND c.AddressTwoNumber <> ''",
    "upper(c.Address1) = upper(f.BuildingName)",
    "upper(c.Address1) = upper(f.SubBuildingName)",
)


def cascade_sql() -> str:
    ctes = [f"WITH cands AS ({CANDIDATES})"]
    for n, rule in enumerate(_RULES, start=1):
        distinct = "" if n == 6 else "DISTINCT"  # the sixth rule keeps repeated address rows
        left_over = " AND ".join(f"c.FanID NOT IN (SELECT FanID FROM rule{m})" for m in range(1, n))
        ctes.append(
            f"""rule{n} AS (SELECT {distinct} {n} AS rule, c.FanID, c.Address1, c.Address2, f.Postcode, f.BuildingNumber,
            f.SubBuildingName, f.BuildingName FROM cands c
            JOIN {{paf}} f ON upper(rtrim(f.Postcode)) = upper(rtrim(c.PostCode)) AND {rule}{" WHERE " + left_over if left_over else ""})"""
        )
    union = " UNION ALL ".join(f"SELECT * FROM rule{n}" for n in range(1, len(_RULES) + 1))
    ctes.append(f"matches AS ({union})")
    ctes.append("single AS (SELECT * FROM matches WHERE FanID IN (SELECT FanID FROM matches GROUP BY FanID HAVING count(*) = 1))")
    ctes.append(
        """hashed AS (SELECT *, upper(sha256(UnhashedAddress)) AS HashedAddress FROM (
            SELECT *, upper(replace('"' || SubBuildingName || '","' || COALESCE(NULLIF(BuildingNumber, ''), BuildingName)
                   || '","' || Postcode || '"', ' ', '')) AS UnhashedAddress FROM single))"""
    )
    ctes.append(
        """found AS (SELECT FanID, cohort_id AS microcell_id, HashedAddress, UnhashedAddress,
            TIMESTAMP '2001-08-02 03:00:00' AS loadDate, 1 AS isCurrentCohort
            FROM hashed JOIN {cohort_addresses} ON hashed_address = HashedAddress)"""
    )
    ctes.append(
        """state AS (SELECT FanID, CINID, microcell_id, HashedAddress, UnhashedAddress, CAST(loadDay AS TIMESTAMP) AS loadDate,
            isCurrentCohort FROM {cohort_state})"""
    )
    ctes.append("ids AS (SELECT FanID, CINID FROM {details} d JOIN {id_map} i ON i.CIN = d.SourceUID)")
    ctes.append(
        """unmatched AS (SELECT * FROM state UNION ALL
            SELECT c.FanID, CINID, -1, NULL, NULL, TIMESTAMP '2001-08-02 03:00:00', 1 FROM cands c JOIN ids USING (FanID)
            WHERE c.FanID NOT IN (SELECT FanID FROM found)
              AND CINID NOT IN (SELECT CINID FROM state WHERE microcell_id = -1))"""
    )
    ctes.append(
        """matched AS (SELECT * FROM unmatched UNION ALL
            SELECT FanID, CINID, min(f.microcell_id), HashedAddress, UnhashedAddress, loadDate, isCurrentCohort
            FROM found f JOIN ids USING (FanID)
            WHERE NOT EXISTS (SELECT 1 FROM unmatched s WHERE s.CINID = ids.CINID AND s.microcell_id = f.microcell_id)
            GROUP BY ALL)"""
    )
    ctes.append(
        """expired AS (SELECT * REPLACE (CASE WHEN loadDate < max(loadDate) OVER (PARTITION BY FanID) THEN 0
            ELSE isCurrentCohort END AS isCurrentCohort) FROM matched)"""
    )
    ctes.append(
        """ranked AS (SELECT FanID, row_number() OVER (PARTITION BY CINID ORDER BY microcell_id DESC, loadDate DESC, FanID DESC) AS rn
            FROM expired WHERE CINID IN (SELECT CINID FROM expired GROUP BY CINID HAVING count(FanID) > 1)),
        settled AS (SELECT * FROM expired WHERE FanID NOT IN (SELECT FanID FROM ranked WHERE rn > 1)),
        chosen AS (SELECT CINID, min(cohort_ID) AS cohort_ID FROM settled JOIN {details} d USING (FanID)
            JOIN {cohort_defaults} c ON c.Postcode_Trim = d.PostCode WHERE microcell_id = -1 GROUP BY CINID),
        defaulted AS (SELECT s.* REPLACE (COALESCE(c.cohort_ID, s.microcell_id) AS microcell_id)
            FROM settled s LEFT JOIN chosen c USING (CINID))"""
    )
    return ",\n".join(ctes)


CASCADE = cascade_sql()


def candidates(r: Roles) -> DataFrame:
    return a.address_candidates(r.people, r.pii, r.cohort_addresses)


def matching(r: Roles) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates, address file and hot postcodes, the first and last stored as in a run."""
    run_id = f"matching-{uuid.uuid4().hex}"
    cands = staged(candidates(r), "candidates", run_id)
    return cands, r.paf, staged(a.hot_postcodes(cands), "hot-postcodes", run_id)


def found(r: Roles) -> DataFrame:
    single = a.match_unambiguous(*matching(r))
    return a.lookup_cohort(a.hash_address(single), r.cohort_addresses, AS_OF)


def state(r: Roles) -> DataFrame:
    return r.cohort_state.select(
        "FanID",
        "CINID",
        "microcell_id",
        "HashedAddress",
        "UnhashedAddress",
        F.col("loadDay").cast("timestamp_ntz").alias("loadDate"),
        "isCurrentCohort",
    )


@query("address_candidates_g1", CANDIDATES)
def _(r: Roles):
    return candidates(r)


@query("cascade_match_g2", CASCADE + " SELECT * FROM matches")
def _(r: Roles):
    return a.cascade_match(*matching(r))


@query("drop_ambiguous_g3", CASCADE + " SELECT * FROM single")
def _(r: Roles):
    return a.drop_ambiguous(a.cascade_match(*matching(r)))


@query("match_unambiguous_g3", CASCADE + " SELECT * FROM single")
def _(r: Roles):
    return a.match_unambiguous(*matching(r))


@query("hash_address_g4", CASCADE + " SELECT FanID, UnhashedAddress, HashedAddress FROM hashed")
def _(r: Roles):
    hashed = a.hash_address(a.match_unambiguous(*matching(r)))
    return hashed.select("FanID", "UnhashedAddress", "HashedAddress")


@query("lookup_cohort_g5", CASCADE + " SELECT * FROM found")
def _(r: Roles):
    return found(r)


@query("add_unmatched_g6", CASCADE + " SELECT * FROM unmatched")
def _(r: Roles):
    return a.add_unmatched(state(r), candidates(r), found(r), r.details, r.id_map, AS_OF)


@query(
    "add_matched_g7",
    CASCADE
    + """ SELECT * FROM state UNION ALL
          SELECT FanID, CINID, min(f.microcell_id), HashedAddress, UnhashedAddress, loadDate, isCurrentCohort
          FROM found f JOIN ids USING (FanID)
          WHERE NOT EXISTS (SELECT 1 FROM state s WHERE s.CINID = ids.CINID AND s.microcell_id = f.microcell_id) GROUP BY ALL""",
)
def _(r: Roles):
    return a.add_matched(state(r), found(r), r.details, r.id_map)


@query(
    "expire_previous_g8",
    CASCADE
    + """ SELECT s.* REPLACE (CASE WHEN s.loadDate <> m.newest THEN 0 ELSE s.isCurrentCohort END AS isCurrentCohort)
          FROM state s JOIN (SELECT FanID, max(loadDate) AS newest FROM state GROUP BY FanID) m USING (FanID)""",
)
def _(r: Roles):
    return a.expire_previous(state(r))


DUPLICATES = """, places AS (SELECT *, row_number() OVER (PARTITION BY CINID ORDER BY microcell_id DESC, loadDate DESC, FanID DESC) AS rn
    FROM state WHERE CINID IN (SELECT CINID FROM state GROUP BY CINID HAVING count(FanID) > 1))"""


@query(
    "drop_duplicate_ids_g9",
    CASCADE + DUPLICATES + " SELECT * FROM state WHERE FanID NOT IN (SELECT FanID FROM places WHERE rn > 1)",
)
def _(r: Roles):
    return a.drop_duplicate_ids(state(r))


@query(
    "drop_duplicate_rows_g9",
    CASCADE
    + DUPLICATES
    + """ SELECT * FROM state WHERE CINID NOT IN (SELECT CINID FROM places)
          UNION ALL SELECT * EXCLUDE (rn) FROM places WHERE rn = 1""",
)
def _(r: Roles):
    return a.drop_duplicate_ids(state(r), whole_customer=False)


@query(
    "postcode_default_g10",
    CASCADE
    + """, defaults AS (SELECT CINID, min(cohort_ID) AS cohort_ID FROM state JOIN {details} d USING (FanID)
             JOIN {cohort_defaults} c ON c.Postcode_Trim = d.PostCode WHERE microcell_id = -1 GROUP BY CINID)
          SELECT s.* REPLACE (COALESCE(c.cohort_ID, s.microcell_id) AS microcell_id) FROM state s LEFT JOIN defaults c USING (CINID)""",
)
def _(r: Roles):
    return a.apply_postcode_default(state(r), r.details, r.cohort_defaults)


@query("refresh_cohorts_g1_g10", CASCADE + " SELECT * FROM defaulted")
def _(r: Roles):
    run_id = f"cohorts-{uuid.uuid4().hex}"
    return a.refresh_cohorts(
        state(r),
        candidates(r),
        r.paf,
        r.cohort_addresses,
        r.cohort_defaults,
        r.details,
        r.id_map,
        AS_OF,
        stage=lambda df, name: staged(df, name, run_id),
    )


SOURCES = ("alpha", "beta", "gamma")
TIE = ["event_id"]
CHANGED = """
    WITH base AS (SELECT * FROM {address_events} WHERE CAST(LoadDate AS DATE) >= DATE '2024-01-05'),
    lagged AS (SELECT *, lag(UpdatedAt) OVER (PARTITION BY CustomerGUID ORDER BY LoadDate, event_id) AS was FROM base),
    changed AS (SELECT * EXCLUDE (was) FROM lagged WHERE (was IS NULL OR UpdatedAt <> was) AND length(trim(PostCode)) >= 6),
    intervals AS (SELECT *, lead(UpdatedAt) OVER (PARTITION BY CustomerGUID ORDER BY UpdatedAt NULLS FIRST, event_id) AS NextUpdatedAt
                  FROM changed),
    external AS (SELECT CustomerGUID, ExternalID AS SourceUID FROM {external_ids} WHERE ExternalIDSource IN ('alpha', 'beta', 'gamma')),
    history AS (SELECT i.*, m.CINID FROM intervals i JOIN external e ON e.CustomerGUID = i.CustomerGUID
                JOIN {id_map} m ON m.CIN = e.SourceUID),
    missing AS (SELECT CustomerGUID, Address1, Address2, PostCode, CINID FROM {pii} p JOIN {id_map} m ON m.CIN = p.SourceUID
                WHERE CustomerGUID NOT IN (SELECT CustomerGUID FROM base)
                  AND SourceUID NOT IN (SELECT SourceUID FROM {duplicate_ids} WHERE EndDate IS NULL)
                  AND CINID NOT IN (SELECT cinid FROM {excluded_ids}) AND CINID NOT IN (SELECT CINID FROM history))"""


def changed(r: Roles) -> DataFrame:
    """Stored, as in a run, since both sides of the history use it."""
    rows = h.changed_rows(r.address_events, EVENTS_FROM, tie=TIE)
    return staged(rows, "changed", f"history-{uuid.uuid4().hex}")


def external(r: Roles) -> DataFrame:
    return h.external_id_map(r.external_ids, SOURCES)


def history(r: Roles, rows: DataFrame) -> DataFrame:
    return h.history_rows(h.validity_intervals(rows, tie=TIE), external(r), r.id_map)


def missing(r: Roles, rows: DataFrame) -> DataFrame:
    base = h.base_events(r.address_events, EVENTS_FROM)
    kept = h.history_rows(rows, external(r), r.id_map)
    return h.missing_from_history(r.pii, r.id_map, base, kept, r.duplicate_ids, r.excluded_ids)


@query("changed_rows_i1", CHANGED + " SELECT * FROM changed")
def _(r: Roles):
    return changed(r)


@query("validity_intervals_i2", CHANGED + " SELECT * FROM intervals")
def _(r: Roles):
    return h.validity_intervals(changed(r), tie=TIE)


@query("external_id_map_i3", CHANGED + " SELECT * FROM external")
def _(r: Roles):
    return h.external_id_map(r.external_ids, SOURCES)


@query("missing_from_history_i4", CHANGED + " SELECT * FROM missing")
def _(r: Roles):
    return missing(r, changed(r))


@query(
    "address_history_i5",
    CHANGED
    + """ SELECT DISTINCT CINID, CustomerAddress1, CustomerAddress2, CustomerAddress3, PostCode, UpdatedAt, NextUpdatedAt FROM history
          UNION ALL SELECT DISTINCT CINID, Address1, Address2, NULL, PostCode, NULL, NULL FROM missing""",
)
def _(r: Roles):
    rows = changed(r)
    return h.address_history(history(r, rows), missing(r, rows))


@query(
    "address_history_incremental_i5",
    CHANGED
    + """ SELECT DISTINCT CINID, CustomerAddress1, CustomerAddress2, CustomerAddress3, PostCode, UpdatedAt, NextUpdatedAt FROM history
          UNION ALL SELECT DISTINCT CINID, Address1, Address2, NULL, PostCode, NULL, NULL FROM missing""",
)
def _(r: Roles):
    """The same table from three runs, each over the events loaded since the one before."""
    root = f"{work_dir(r.spark)}/history-{uuid.uuid4().hex}"
    cuts = r.address_events.agg(F.percentile_approx(F.col("LoadDate").cast("timestamp"), [0.4, 0.8]).alias("q")).first()["q"]
    loaded = F.col("LoadDate").cast("timestamp")
    for i, (low, high) in enumerate(zip([None, *cuts], [*cuts, None])):
        since = r.address_events if low is None else r.address_events.where(loaded > F.lit(low))
        part = since if high is None else since.where(loaded <= F.lit(high))
        run_address_history_daily(r.spark, part, EVENTS_FROM, RunContext(f"day-{i}", AS_OF), root, TIE, work=f"{root}/work")
    t = AddressTables(r.address_events, r.external_ids, r.id_map, r.pii, r.duplicate_ids, r.excluded_ids)
    return daily_address_history(t, address_state(r.spark, root), SOURCES)
