"""Merchant dimension: cleaning, keys, upsert and scope."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.config import MerchantScope, NarrativeRules
from cardloom.functions.compat import blank_to_null, like_any, text30, text_in, text_key
from cardloom.functions.joins import anti, salted_join, semi
from cardloom.functions.keys import (
    clean_narrative,
    combo_id,
    combo_id_spaceless,
    merchant_tuple_hash,
    without_commas,
)
from cardloom.sources.buckets import BucketedState


def clean_narratives_incremental(
    merchants: DataFrame, cache: DataFrame, clean: Callable[[Column], Column] = clean_narrative
) -> DataFrame:
    """Cache entries for non-blank narratives not cached yet.

    Narratives that differ only in case or trailing spaces are one narrative; the
    smallest spelling represents it.
    """
    spelled = merchants.where(F.rtrim("Narrative") > "").withColumn("_key", text_key("Narrative"))
    distinct = spelled.groupBy("_key").agg(F.min("Narrative").alias("Narrative"))
    fresh = anti(distinct, cache.select(text_key("Narrative").alias("_key")), ["_key"])
    return fresh.select("Narrative", clean(F.col("Narrative")).alias("NarrativeCleaned"))


def final_postcode() -> Column:
    """The alternate postcode unless blank, else the primary one."""
    return F.coalesce(blank_to_null("_alternate"), F.col("_primary"))


def _with_postcodes(
    merchants: DataFrame, postcodes: DataFrame, alternates: DataFrame, locations: DataFrame
) -> DataFrame:
    primary = postcodes.select("ConsumerCombinationID", "LocationID", F.col("PostCode").alias("_primary"))
    places = locations.select(F.col("ID").alias("AlternateLocationID"), F.col("PostCode").alias("_alternate"))
    other = alternates.select("ConsumerCombinationID", "AlternateLocationID").join(
        places, "AlternateLocationID", "left"
    )
    return merchants.join(primary, "ConsumerCombinationID", "left").join(other, "ConsumerCombinationID", "left")


def merchant_base(
    merchants: DataFrame,
    postcodes: DataFrame,
    alternates: DataFrame,
    locations: DataFrame,
    cache: DataFrame,
) -> DataFrame:
    """Merchants with both postcodes, the cleaned narrative and the postcode to use."""
    cleaned = cache.select(text_key("Narrative").alias("_key"), "NarrativeCleaned")
    full = _with_postcodes(merchants, postcodes, alternates, locations)
    full = full.withColumn("_key", text_key("Narrative")).join(cleaned, "_key", "left")
    return full.select(
        "ConsumerCombinationID",
        "BrandID",
        "LocationCountry",
        "MCCID",
        "IsUKSpend",
        F.coalesce(F.col("_primary"), F.lit("")).alias("PostCode"),
        F.coalesce(F.col("LocationID"), F.lit(0)).alias("LocationID"),
        F.coalesce(F.col("_alternate"), F.lit("")).alias("AlternatePostCode"),
        F.coalesce(F.col("AlternateLocationID"), F.lit(0)).alias("AlternateLocationID"),
        without_commas("MID").alias("MID"),
        F.col("NarrativeCleaned").alias("Narrative"),
        final_postcode().alias("FinalPostcode"),
        "OriginatorID",
    )


def merchant_detail(
    merchants: DataFrame, postcodes: DataFrame, alternates: DataFrame, locations: DataFrame
) -> DataFrame:
    """Merchant table of the detailed feed: commas removed, one postcode."""
    full = _with_postcodes(merchants, postcodes, alternates, locations)
    return full.select(
        *[c for c in merchants.columns if c not in ("MID", "Narrative")],
        without_commas("MID").alias("MID"),
        without_commas("Narrative").alias("Narrative"),
        final_postcode().alias("Postcode"),
    )


def merchant_keys(base: DataFrame, mcc: DataFrame) -> DataFrame:
    """Merchant table with combination id and tuple hash; unknown categories drop out."""
    coded = base.join(mcc.select("MCCID", "MCC"), "MCCID")
    return coded.select(
        "ConsumerCombinationID",
        "BrandID",
        F.trim("LocationCountry").alias("LocationCountry"),
        "MCCID",
        "PostCode",
        "MID",
        "Narrative",
        F.col("PostCode").alias("rawPostcode"),
        F.col("AlternatePostCode").alias("rawAlternatePostcode"),
        F.col("MID").alias("rawMID"),
        F.col("Narrative").alias("rawNarrative"),
        "FinalPostcode",
        combo_id("MID", "Narrative", "FinalPostcode").alias("ComboID"),
        merchant_tuple_hash("LocationCountry", "Narrative", "OriginatorID", "MCC", "MID").alias("ProxyMIDTupleID"),
    )


def upsert_merchants(target: DataFrame, source: DataFrame) -> DataFrame:
    """New merchant table: unknown ids added without commas, brands brought up to date.

    A NULL brand on either side is not a difference, so it changes nothing.
    """
    brands = source.groupBy("ConsumerCombinationID").agg(F.min("BrandID").alias("_brand"))
    moved = F.when(F.col("_brand") != F.col("BrandID"), F.col("_brand")).otherwise(F.col("BrandID"))
    kept = target.join(brands, "ConsumerCombinationID", "left").withColumn("BrandID", moved)
    added = anti(source, target, ["ConsumerCombinationID"]).withColumns(
        {"MID": without_commas("MID"), "Narrative": without_commas("Narrative")}
    )
    return kept.select(*target.columns).unionByName(added.select(*target.columns))


def changed_merchants(target: DataFrame, source: DataFrame) -> DataFrame:
    """The rows that :func:`upsert_merchants` adds or changes, with all rows of their ids."""
    known = target.select("ConsumerCombinationID", F.col("BrandID").alias("_old"))
    brands = source.groupBy("ConsumerCombinationID").agg(F.min("BrandID").alias("_brand"))
    moved = known.join(brands, "ConsumerCombinationID").where(F.col("_brand") != F.col("_old"))
    theirs = semi(target, moved, ["ConsumerCombinationID"])
    wanted = source.join(known.select("ConsumerCombinationID").distinct().withColumn("_known", F.lit(True)), "ConsumerCombinationID", "left")
    new = wanted.where(F.col("_known").isNull()).select(*source.columns)
    return upsert_merchants(theirs, semi(source, moved, ["ConsumerCombinationID"]).unionByName(new))


def upsert_merchants_state(state: BucketedState, source: DataFrame, version: str, stage: Callable[[DataFrame, str], DataFrame]) -> list[int]:
    """The merchant table as a bucketed state by id: only buckets with an added or rebranded merchant are rewritten."""
    return state.upsert(stage(changed_merchants(state.read(), source), "changed-merchants"), version)


def merchant_scope(
    merchants: DataFrame, brands: DataFrame, sectors: DataFrame, mcc: DataFrame, scope: MerchantScope
) -> DataFrame:
    """Distinct merchants of scoped sector groups and brands, or of scoped categories.

    Both reasons are flags on one pass over the merchants instead of a union of two.
    """
    groups = sectors.select("SectorID", "SectorGroupID")
    by_brand = (
        brands.select("BrandID", "SectorID")
        .join(groups, "SectorID")
        .where(F.col("SectorGroupID").isin(list(scope.sector_groups)) | F.col("BrandID").isin(list(scope.brands)))
        .select("BrandID", F.lit(True).alias("_brand"))
    )
    by_mcc = mcc.where(F.col("MCCID").isin(list(scope.mccs))).select("MCCID", F.lit(True).alias("_mcc"))
    flagged = merchants.join(by_brand, "BrandID", "left").join(by_mcc, "MCCID", "left")
    wanted = F.col("_brand").isNotNull() | F.col("_mcc").isNotNull()
    return flagged.where(wanted).select(*merchants.columns).distinct()


GRAM = 3
#: Texts of a task that looks up rules; a text has many pieces.
TEXTS_PER_TASK = 20_000
#: Up to so many rules the index goes to every task.
FEW_RULES = 100_000


def grams(text: Column, size: int = GRAM) -> Column:
    """Distinct pieces of ``size`` characters of a text."""
    n = F.char_length(text)
    return F.when(n >= size, F.array_distinct(F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.substring(text, i, F.lit(size)))))


def longest_literal(pattern: Column) -> Column:
    """The longest text without wildcards and escapes in a LIKE pattern."""
    parts = F.split(pattern, r"\\.|[%_]")
    return F.aggregate(parts, F.lit(""), lambda best, p: F.when(F.char_length(p) > F.char_length(best), p).otherwise(best))


def match_rules(df: DataFrame, rules: DataFrame, column: str, key: str) -> DataFrame:
    """(key, rule): which LIKE rules (rule, pattern) a text matches, without case, for any number of rules.

    A rule is filed under the piece of its longest literal that the fewest texts have, and a text looks up its own pieces;
    what meets there is verified by the pattern.  A rule whose literals are shorter than ``GRAM`` characters is filed under
    the empty piece, which every text has.  The plan does not grow with the rules.  NULLs match nothing.
    Texts are dealt to tasks by their number, and which side is broadcast follows from the number of rules, since
    a file, by whose size the planner goes, is small beside the pieces of its texts.
    """
    texts = df.select(F.col(key), F.lower(column).alias("_text")).where(F.col("_text").isNotNull())
    tasks = max(1, -(-texts.count() // TEXTS_PER_TASK))
    texts = texts.repartition(tasks, key, "_text").distinct()
    patterns = rules.where(F.col("pattern").isNotNull()).select("rule", F.lower("pattern").alias("_pattern")).distinct()
    none = F.array(F.lit(""))
    filed = patterns.select("rule", "_pattern", F.explode(F.coalesce(grams(longest_literal(F.col("_pattern"))), none)).alias("_gram"))
    side = F.broadcast if patterns.count() <= FEW_RULES else lambda df: df.hint("merge")
    wanted = side(filed.select("_gram").distinct())
    pieces = texts.select(key, "_text", F.explode(F.concat(none, F.coalesce(grams(F.col("_text")), F.array().cast("array<string>")))).alias("_gram"))
    pieces = pieces.join(wanted, "_gram", "left_semi")
    often = pieces.groupBy("_gram").agg(F.count(F.lit(1)).alias("_often"))
    place = F.struct(F.coalesce("_often", F.lit(0)).alias("n"), "_gram")
    index = filed.join(often, "_gram", "left").groupBy("rule", "_pattern").agg(F.min(place).alias("_least"))
    index = index.select("rule", "_pattern", F.col("_least._gram").alias("_gram"))
    met = pieces.join(side(index), "_gram").where(F.like("_text", F.col("_pattern")))
    return met.select(key, "rule").distinct()


def without_matches(df: DataFrame, rules: DataFrame, column: str, key: str) -> DataFrame:
    """Rows whose text matches no rule; the same as a chain of LIKE, by the index of the rules."""
    return anti(df, match_rules(df, rules, column, key), [key])


def narrative_rules(df: DataFrame, rules: NarrativeRules) -> DataFrame:
    """Merchants kept by the narrative rules.

    Kept are home-country narratives that are neither listed nor match an excluded
    pattern, and anything an include rule names.  Entries of the exact lists are
    literal texts even when they contain wildcards.
    """
    home = (
        ~text_in("Narrative", rules.excluded_exact)
        & ~like_any("Narrative", rules.excluded_like)
        & text_in(F.trim("LocationCountry"), rules.home_countries)
    )
    named = text_in(F.trim("Narrative"), rules.included_narratives) & F.col("MCCID").isin(
        list(rules.included_narrative_mccs)
    )
    included = (
        text_in("MID", rules.included_mids)
        | like_any("Narrative", rules.included_like)
        | text_in(F.concat(F.lit("MID"), text30("MID")), rules.included_prefixed_mids)
        | named
    )
    return df.where(home | included)


def with_combo(merchants: DataFrame) -> DataFrame:
    """Merchants with the second form of the combination id."""
    return merchants.withColumn("comboid_generated", combo_id_spaceless("MID", "Narrative", "FinalPostcode"))


def expand_by_combo(scope: DataFrame, all_merchants: DataFrame) -> DataFrame:
    """Every merchant that shares a combination id with a scoped one.

    The id is computed once per merchant and used on both sides.
    """
    combined = with_combo(all_merchants)
    scoped = semi(combined, scope, ["ConsumerCombinationID"]).select("comboid_generated").distinct()
    return salted_join(combined, scoped, ["comboid_generated"], "left_semi", ["ConsumerCombinationID"]).select(
        "ConsumerCombinationID",
        "BrandID",
        "LocationCountry",
        "MCCID",
        "MID",
        "Narrative",
        "comboid_generated",
    )
