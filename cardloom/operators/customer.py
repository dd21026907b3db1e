"""Customer profile and customer feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions.bands import AGE_DETAILED, AGE_GROUP, AGE_INSIGHT, AGE_NUMBER, band
from cardloom.functions.compat import (
    base_date_to_null,
    blank_to_null,
    text_key,
    trimmed_or_null,
    zero_to_null,
)
from cardloom.functions.joins import anti, not_in
from cardloom.functions.keys import coded_label, postal_sector, postcode_key, unquoted


def age_bands(df: DataFrame, age: str = "AgeCurrent") -> DataFrame:
    """The four age band columns of a profile."""
    return df.withColumns(
        {
            "AgeCurrentBandNumber": band(age, AGE_NUMBER),
            "AgeGroup": band(age, AGE_GROUP),
            "Insight_AgeBand": band(age, AGE_INSIGHT),
            "HDI_AgeBand": band(age, AGE_DETAILED),
        }
    )


def exclude_customers(
    df: DataFrame,
    duplicates: DataFrame,
    excluded: DataFrame | None = None,
    open_only: bool = True,
    null_aware: bool = True,
) -> DataFrame:
    """Drop duplicate source ids and excluded customers.

    ``open_only`` looks at duplicates without an end date only.  ``null_aware`` is
    ``NOT IN`` (a NULL in a list removes everything), otherwise ``NOT EXISTS``.
    """
    listed = duplicates.where(F.col("EndDate").isNull()) if open_only else duplicates
    if not null_aware:
        kept = anti(df, listed, ["SourceUID"])
        return kept if excluded is None else anti(kept, excluded.withColumnRenamed("cinid", "CINID"), ["CINID"])
    kept = not_in(df, "SourceUID", listed)
    return kept if excluded is None else not_in(kept, "CINID", excluded, "cinid")


def attach_acorn(df: DataFrame, acorn: DataFrame) -> DataFrame:
    """Left join of the area classification on the cleaned postcode."""
    codes = acorn.select(
        postcode_key("postcode").alias("_area"),
        unquoted("acorncode2022").alias("acorncode2022"),
        unquoted("acorncode2023").alias("acorncode2023"),
    )
    keyed = df.withColumn("_area", postcode_key("PostCode"))
    return keyed.join(codes, "_area", "left").drop("_area")


def attach_cameo(df: DataFrame, cameo: DataFrame, cameo_group: DataFrame) -> DataFrame:
    """Left join of the second classification on the postcode as written."""
    groups = cameo_group.select("CAMEO_CODE_GROUP", "CAMEO_CODE_GROUP_Category")
    codes = (
        cameo.select(text_key("postcode").alias("_code"), "CAMEO_CODE_GROUP")
        .join(groups, "CAMEO_CODE_GROUP", "left")
        .select("_code", coded_label("CAMEO_CODE_GROUP", "CAMEO_CODE_GROUP_Category").alias("_label"))
    )
    keyed = df.withColumn("_code", text_key("PostCode"))
    label = F.coalesce(F.col("_label"), F.lit("99. Unknown"))
    return keyed.join(codes, "_code", "left").withColumn("CAMEO_CODE_GRP", label).drop("_code", "_label")


def customer_profile(
    customers: DataFrame,
    id_map: DataFrame,
    acorn: DataFrame,
    cameo: DataFrame,
    cameo_group: DataFrame,
    cohorts: DataFrame,
    duplicates: DataFrame,
    excluded: DataFrame,
    details: DataFrame | None = None,
    sector_from_postcode: bool = False,
) -> DataFrame:
    """One row per customer and match: geography codes, age bands, cohort and dates.

    The two exclusions run before the classification joins, which only add columns.
    """
    people = customers.join(id_map.select(F.col("CIN").alias("SourceUID"), "CINID"), "SourceUID")
    people = exclude_customers(people, duplicates, excluded)
    if details is not None:
        people = people.join(details.select("FanID", "DOB"), "FanID", "left")
    else:
        people = people.withColumn("DOB", F.lit(None).cast("date"))
    people = attach_cameo(attach_acorn(people, acorn), cameo, cameo_group)
    people = people.join(cohorts.select("CINID", "microcell_id"), "CINID", "left")
    if sector_from_postcode:
        people = people.withColumn("PostalSector", postal_sector("PostCode"))
    return age_bands(people).select(
        F.col("SourceUID").alias("CIN"),
        "CINID",
        "Gender",
        "DOB",
        "PostCode",
        "PostalSector",
        "PostCodeDistrict",
        "PostArea",
        "AgeCurrentBandNumber",
        "AgeGroup",
        "Insight_AgeBand",
        "HDI_AgeBand",
        F.coalesce(F.col("Region"), F.lit("Unknown")).alias("Region"),
        "CAMEO_CODE_GRP",
        "acorncode2022",
        "acorncode2023",
        "microcell_id",
        "RegistrationDate",
        "DeactivatedDate",
    )


def customer_feed(id_map: DataFrame, profile: DataFrame, detailed: bool = False) -> DataFrame:
    """Every known id with its profile, blanks as NULL, without duplicates.

    Comparing a number with '' compares with 0, so band number 0 and cohort 0
    become NULL as well.  The detailed feed also has the whole postcode.
    """
    postcode = [blank_to_null("PostCode").alias("postcode")] if detailed else []
    ids = id_map.select("CIN", F.col("CINID").alias("cinid"))
    known = profile.drop("CINID").withColumn("_found", F.lit(True))
    active = F.col("_found").isNotNull() & F.col("DeactivatedDate").isNull()
    return (
        ids.join(known, "CIN", "left")
        .select(
            "cinid",
            trimmed_or_null("Gender").alias("gender"),
            blank_to_null("PostalSector").alias("postalsector"),
            blank_to_null("PostCodeDistrict").alias("postcodedistrict"),
            blank_to_null("PostArea").alias("postarea"),
            *postcode,
            blank_to_null("Region").alias("region"),
            zero_to_null("AgeCurrentBandNumber").alias("agecurrentbandnumber"),
            blank_to_null("AgeGroup").alias("agegroup"),
            blank_to_null("CAMEO_CODE_GRP").alias("cameo_code_grp"),
            F.coalesce(F.col("Insight_AgeBand"), F.lit("99. Unknown")).alias("insight_ageband"),
            blank_to_null("HDI_AgeBand").alias("hdi_ageband"),
            trimmed_or_null("acorncode2022").alias("acorncode2022"),
            trimmed_or_null("acorncode2023").alias("acorncode2023"),
            F.when(active, 1).otherwise(0).alias("inprogram"),
            zero_to_null("microcell_id").alias("microcell_id"),
            base_date_to_null("RegistrationDate").alias("RegistrationDate"),
            base_date_to_null("DeactivatedDate").alias("DeactivatedDate"),
        )
        .distinct()
    )
