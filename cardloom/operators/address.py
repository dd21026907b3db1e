"""Matching customer addresses to cohorts, and the state of those matches."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions.compat import sha256_hex, text_key
from cardloom.functions.joins import anti, hot_keys, salted_join, semi, with_group_values
from cardloom.functions.keys import address_text, digits

ADDRESS = ("Postcode", "BuildingNumber", "SubBuildingName", "BuildingName")
MATCH = ("FanID", "Address1", "Address2", *ADDRESS)

# Rule that keeps repeated address-file rows; all others count equal rows once.
KEEPS_REPEATS = 6


def address_candidates(customers: DataFrame, pii: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Customers of covered postal sectors with the numbers in their two address lines."""
    sectors = cohorts.select(text_key("postcode_sector").alias("_sector")).distinct()
    keyed = customers.withColumn("_sector", text_key("PostalSector"))
    covered = salted_join(keyed, sectors, ["_sector"], "left_semi", ["FanID"])
    lines = pii.select("FanID", "Address1", "Address2")
    return covered.join(lines, "FanID").select(
        "FanID",
        "PostCode",
        "PostalSector",
        "Address1",
        "Address2",
        digits("Address1").alias("AddressOneNumber"),
        digits("Address2").alias("AddressTwoNumber"),
    )


def _probe(rule: int, field: str, first: Column, second: Column, usable: Column) -> Column:
    probe = F.struct(
        F.lit(rule).alias("rule"),
        F.lit(field).alias("field"),
        first.alias("first"),
        second.alias("second"),
    )
    return F.when(usable & first.isNotNull() & second.isNotNull(), probe)


def candidate_probes(cands: DataFrame) -> DataFrame:
    """One row per customer and usable rule, with the key the rule looks up.

    All rules ask for the same postcode plus one or two fields, so a rule is only a
    number, the field it searches and two key values: seven rules, one join.
    """
    one, two = text_key("AddressOneNumber"), text_key("AddressTwoNumber")
    line = text_key("Address1")
    none = F.lit("")
    probes = F.array(
        _probe(1, "number+subnumber", two, one, two != ""),
        _probe(2, "number+subnumber", one, two, two != ""),
        _probe(3, "number", one, none, one != ""),
        _probe(4, "number+subname", two, line, two != ""),
        _probe(5, "number", two, none, two != ""),
        _probe(6, "name", line, none, F.lit(True)),
        _probe(7, "subname", line, none, F.lit(True)),
    )
    return cands.select(
        "FanID", "Address1", "Address2", text_key("PostCode").alias("_pc"), F.explode(F.array_compact(probes)).alias("p")
    ).select("FanID", "Address1", "Address2", "_pc", "p.*")


def address_lookups(paf: DataFrame) -> DataFrame:
    """Address-file rows under every field combination the rules search."""
    number, name = text_key("BuildingNumber"), text_key("BuildingName")
    sub_number, sub_name = text_key("SubBuildingNumber"), text_key("SubBuildingName")
    none = F.lit("")

    def entry(field: str, first: Column, second: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), first.alias("first"), second.alias("second"))

    entries = F.array(
        entry("number+subnumber", number, sub_number),
        entry("number", number, none),
        entry("number+subname", number, sub_name),
        entry("name", name, none),
        entry("subname", sub_name, none),
    )
    return (
        paf.select(*ADDRESS, text_key("Postcode").alias("_pc"), F.explode(entries).alias("e"))
        .select(*ADDRESS, "_pc", "e.*")
        .where(F.col("first").isNotNull() & F.col("second").isNotNull())
    )


LOOKUP = ("_pc", "field", "first", "second")


def hot_postcodes(cands: DataFrame) -> DataFrame:
    """Postcodes with very many candidates: a lookup key can only be hot within one."""
    return hot_keys(cands.select(text_key("PostCode").alias("_pc")), ["_pc"])


def _same_address() -> list[Column]:
    """Address columns as they are compared: without case and trailing spaces."""
    return [text_key(c).alias(f"_key_{c}") for c in ADDRESS]


def cascade_match(cands: DataFrame, paf: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Address-file matches of each customer under the first rule that finds any.

    The rules run in order and each sees only customers without a match so far,
    which is the lowest matching rule number per customer.  That rule is found from the
    distinct lookup keys first, and only its probes meet the addresses.  Addresses that differ in
    case or trailing spaces only are one, in the smallest spelling; rule 6 still counts rows.
    ``hot`` lists hot postcodes, where the caller has them from a stored table.
    """
    hot = hot_postcodes(cands) if hot is None else hot
    known = address_lookups(paf).select(*LOOKUP).distinct()
    found = salted_join(candidate_probes(cands), known, LOOKUP, "left_semi", ["FanID"], hot)
    best = found.groupBy("FanID").agg(F.min("rule").alias("rule"))
    hits = semi(found, best, ["FanID", "rule"]).join(address_lookups(paf), list(LOOKUP))
    same = hits.groupBy("rule", "FanID", "Address1", "Address2", *_same_address())
    counted = same.agg(F.count(F.lit(1)).alias("_rows"), F.min(F.struct(*ADDRESS)).alias("_spelt"))
    repeats = F.when(F.col("rule") == KEEPS_REPEATS, F.col("_rows")).otherwise(F.lit(1).cast("long"))
    rows = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), repeats)))
    return rows.select("rule", "FanID", "Address1", "Address2", "_spelt.*")


def drop_ambiguous(matches: DataFrame) -> DataFrame:
    """Matches of customers that have exactly one."""
    others = [c for c in matches.columns if c != "FanID"]
    single = matches.groupBy("FanID").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*others)).alias("_row"))
    return single.where(F.col("_n") == 1).select("FanID", "_row.*").select(*matches.columns)


def match_unambiguous(cands: DataFrame, paf: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """``drop_ambiguous(cascade_match(...))`` without listing the ambiguous matches.

    Only customers with a single match survive, so each lookup key is first reduced
    to its smallest and largest address and a row count (combined before the
    shuffle).  A probe then meets at most one row, also where thousands of address
    rows share a blank name or a postcode.
    """
    hot = hot_postcodes(cands) if hot is None else hot
    same = F.struct(*_same_address())
    address = F.struct(same.alias("key"), F.struct(*ADDRESS).alias("spelt"))
    reduced = (
        address_lookups(paf)
        .groupBy(*LOOKUP)
        .agg(F.min(address).alias("_low"), F.max(same).alias("_high"), F.count(F.lit(1)).alias("_rows"))
    )
    hits = salted_join(candidate_probes(cands), reduced, LOOKUP, "inner", ["FanID"], hot)
    lines = ("Address1", "Address2")
    per_fan = hits.groupBy("FanID").agg(
        F.min(F.struct("rule", *lines, "_low")).alias("_first"),
        F.max(F.struct((-F.col("rule")).alias("rule"), *lines, "_high")).alias("_last"),
        F.sum(F.when(F.col("rule") == KEEPS_REPEATS, F.col("_rows")).otherwise(0)).alias("_repeats"),
    )
    same = (
        F.col("_first.Address1").eqNullSafe(F.col("_last.Address1"))
        & F.col("_first.Address2").eqNullSafe(F.col("_last.Address2"))
        & F.col("_first._low.key").eqNullSafe(F.col("_last._high"))
    )
    once = (F.col("_first.rule") != KEEPS_REPEATS) | (F.col("_repeats") == 1)
    return per_fan.where(same & once).select(
        "_first.rule", "FanID", "_first.Address1", "_first.Address2", "_first._low.spelt.*"
    )


def hash_address(matches: DataFrame) -> DataFrame:
    """Matches with the canonical address text and its hash."""
    text = address_text("SubBuildingName", "BuildingNumber", "BuildingName", "Postcode")
    return matches.withColumn("UnhashedAddress", text).withColumn("HashedAddress", sha256_hex("UnhashedAddress"))


def lookup_cohort(hashed: DataFrame, cohorts: DataFrame, as_of: datetime) -> DataFrame:
    """Matched customers with the cohort of their hashed address."""
    known = cohorts.select(F.col("hashed_address").alias("HashedAddress"), F.col("cohort_id").alias("microcell_id"))
    return hashed.join(known, "HashedAddress").select(
        "FanID",
        "microcell_id",
        "HashedAddress",
        "UnhashedAddress",
        F.lit(as_of).cast("timestamp_ntz").alias("loadDate"),
        F.lit(1).alias("isCurrentCohort"),
    )


NO_COHORT = -1


def _with_card_id(fans: DataFrame, details: DataFrame, id_map: DataFrame) -> DataFrame:
    ids = details.select("FanID", "SourceUID").join(
        id_map.select(F.col("CIN").alias("SourceUID"), "CINID"), "SourceUID"
    )
    return fans.join(ids.drop("SourceUID"), "FanID")


def add_unmatched(
    state: DataFrame,
    cands: DataFrame,
    matched: DataFrame,
    details: DataFrame,
    id_map: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """State plus a no-cohort row for candidates without a match, unless their card id has one."""
    left_over = anti(cands.select("FanID"), matched, ["FanID"])
    ids = _with_card_id(left_over, details, id_map)
    fresh = anti(ids, state.where(F.col("microcell_id") == NO_COHORT), ["CINID"])
    rows = fresh.select(
        "FanID",
        "CINID",
        F.lit(NO_COHORT).alias("microcell_id"),
        F.lit(None).cast("string").alias("HashedAddress"),
        F.lit(None).cast("string").alias("UnhashedAddress"),
        F.lit(as_of).cast("timestamp_ntz").alias("loadDate"),
        F.lit(1).alias("isCurrentCohort"),
    )
    return state.unionByName(rows.select(*state.columns))


def add_matched(state: DataFrame, matched: DataFrame, details: DataFrame, id_map: DataFrame) -> DataFrame:
    """State plus matched customers, lowest cohort per address; known (card id, cohort) pairs are skipped."""
    fresh = anti(_with_card_id(matched, details, id_map), state, ["CINID", "microcell_id"])
    rows = fresh.groupBy("FanID", "CINID", "HashedAddress", "UnhashedAddress", "loadDate", "isCurrentCohort").agg(
        F.min("microcell_id").alias("microcell_id")
    )
    return state.unionByName(rows.select(*state.columns))


def expire_previous(state: DataFrame) -> DataFrame:
    """Current flag 0 on rows older than the newest of their customer."""
    dated = with_group_values(state, ["FanID"], ["CINID", "loadDate"], _newest=F.max("loadDate"))
    old = (F.col("loadDate") != F.col("_newest")) & (F.col("isCurrentCohort") == 1)
    flag = F.when(old, 0).otherwise(F.col("isCurrentCohort"))
    return dated.withColumn("isCurrentCohort", flag).select(*state.columns)


def drop_duplicate_ids(state: DataFrame, whole_customer: bool = True) -> DataFrame:
    """Resolve card ids held by several rows in favour of the highest cohort.

    By default every customer that owns one of the lower rows goes entirely, with its
    best row too.  ``whole_customer=False`` removes only the lower rows.  Ties in the
    cohort go to the newest row, then the highest customer id.
    """
    place = F.struct("microcell_id", "loadDate", "FanID")
    owned = (
        state.where(F.col("CINID").isNotNull())
        .groupBy("CINID", "FanID")
        .agg(F.count(F.lit(1)).alias("_rows"), F.max(place).alias("_best"))
    )
    tops = owned.groupBy("CINID").agg(
        F.max("_best").alias("_top"),
        F.sum(F.when(F.col("FanID").isNotNull(), F.col("_rows")).otherwise(0)).alias("_held"),
    )
    tops = tops.where(F.col("_held") > 1)
    if not whole_customer:
        ranked = salted_join(state, tops.drop("_held"), ["CINID"], "left", ["FanID"])
        best = F.col("_top").isNull() | place.eqNullSafe(F.col("_top"))
        return ranked.where(best).select(*state.columns)
    lower = (F.col("_rows") > 1) | ~F.col("FanID").eqNullSafe(F.col("_top.FanID"))
    losers = salted_join(owned, tops, ["CINID"], "inner", ["FanID"]).where(lower).select("FanID").distinct()
    return anti(state, losers, ["FanID"])


def apply_postcode_default(state: DataFrame, details: DataFrame, defaults: DataFrame) -> DataFrame:
    """Cohort default of the postcode on all rows of card ids that have a no-cohort row.

    Where several defaults apply the lowest is taken.
    """
    by_postcode = defaults.select(text_key("Postcode_Trim").alias("_pc"), "cohort_ID")
    places = details.select("FanID", text_key("PostCode").alias("_pc"))
    missing = state.where(F.col("microcell_id") == NO_COHORT).select("FanID", "CINID")
    chosen = (
        missing.join(places, "FanID")
        .join(by_postcode, "_pc")
        .groupBy("CINID")
        .agg(F.min("cohort_ID").alias("_default"))
    )
    cohort = F.coalesce(F.col("_default"), F.col("microcell_id"))
    joined = salted_join(state, chosen, ["CINID"], "left", ["FanID"])
    return joined.withColumn("microcell_id", cohort).select(*state.columns)


def refresh_cohorts(
    state: DataFrame,
    cands: DataFrame,
    paf: DataFrame,
    cohorts: DataFrame,
    defaults: DataFrame,
    details: DataFrame,
    id_map: DataFrame,
    as_of: datetime,
    stage: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    """The whole match step: old state in, new state out, with one clock reading.

    Every step compares the state with itself, which would multiply the lineage at
    each one; ``stage`` writes a named intermediate table and reads it back.
    """
    cands = stage(cands, "candidates")
    hot = stage(hot_postcodes(cands), "hot-postcodes")
    matched = lookup_cohort(hash_address(match_unambiguous(cands, paf, hot)), cohorts, as_of)
    matched = stage(matched, "matched")
    grown = stage(add_unmatched(state, cands, matched, details, id_map, as_of), "with-unmatched")
    grown = stage(add_matched(grown, matched, details, id_map), "with-matched")
    settled = stage(drop_duplicate_ids(expire_previous(grown)), "settled")
    return apply_postcode_default(settled, details, defaults)
