"""Pseudonymised customer table and its change-only upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions.joins import anti, semi
from cardloom.functions.keys import proxy_user_hash, row_checksum
from cardloom.sources.buckets import BucketedState

POPULATION = (
    "FanID",
    "CompositeID",
    "CINID",
    "ClubID",
    "PostcodeDistrict",
    "SourceUID",
    "rw",
    "PostalArea",
)
CHECKED = ("ProxyUserID", *POPULATION[1:])


def preferred_card(
    customers: DataFrame, id_map: DataFrame, consents: DataFrame, clubs: Sequence[int]
) -> DataFrame:
    """Consenting members of the given clubs, one row per source id: the lowest club.

    The lowest row is a ``min`` over a struct, which combines before the shuffle;
    ties in the club go to the lowest customer id.
    """
    agreed = consents.where(F.col("AgreedTerms") == 1).select("CustomerGUID").distinct()
    members = customers.where(F.col("ClubID").isin(list(clubs)))
    members = semi(members, agreed, ["CustomerGUID"])
    members = members.join(id_map.select(F.col("CIN").alias("SourceUID"), "CINID"), "SourceUID")
    first = F.min(
        F.struct(
            "ClubID",
            "FanID",
            "CINID",
            "CompositeID",
            F.col("PostCodeDistrict").alias("PostcodeDistrict"),
            F.col("PostArea").alias("PostalArea"),
        )
    )
    picked = members.groupBy("SourceUID").agg(first.alias("_first")).select("SourceUID", "_first.*")
    return picked.withColumn("rw", F.lit(1)).select(*POPULATION)


def affinity_population(primary: DataFrame, secondary: DataFrame, clubs: Sequence[int]) -> DataFrame:
    """Preferred cards plus members of the secondary clubs, who have no card id or address."""
    others = secondary.where(F.col("ClubID").isin(list(clubs))).select(
        F.col("ID").alias("FanID"),
        "CompositeID",
        F.lit(None).cast(primary.schema["CINID"].dataType).alias("CINID"),
        "ClubID",
        F.lit(None).cast("string").alias("PostcodeDistrict"),
        "SourceUID",
        F.lit(1).alias("rw"),
        F.lit(None).cast("string").alias("PostalArea"),
    )
    return primary.unionByName(others)


def proxy_user_id(population: DataFrame, offset: int) -> DataFrame:
    """Population with its pseudonym; the offset is a secret of the deployment."""
    return population.withColumn("ProxyUserID", proxy_user_hash("FanID", "SourceUID", offset))


def row_checksums(population: DataFrame) -> DataFrame:
    """Population with the change detector over pseudonym, ids and address."""
    return population.withColumn("Chksum", row_checksum(*CHECKED))


def upsert_changed(target: DataFrame, source: DataFrame) -> DataFrame:
    """New state of the customer table.

    Known customers with another checksum get district, area and checksum of the
    source, nothing else.  Rows whose customer id and card id are both new (a NULL
    card id always counts as new) are added with ``isNew`` 1.  Nothing is deleted.
    """
    latest = source.groupBy("FanID").agg(
        F.min(F.struct("Chksum", "PostcodeDistrict", "PostalArea")).alias("_new")
    )
    changed = F.col("_new.Chksum") != F.col("Chksum")
    columns = {
        name: F.when(changed, F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name)
        for name in ("PostcodeDistrict", "PostalArea", "Chksum")
    }
    kept = target.join(latest, "FanID", "left").select(*[columns.get(c, F.col(c)) for c in target.columns])
    added = anti(anti(source, target, ["FanID"]), target, ["CINID"]).withColumn("isNew", F.lit(1))
    return kept.unionByName(added.select(*target.columns))


def changed_customers(target: DataFrame, source: DataFrame) -> DataFrame:
    """Rows of the new state that are not in the old one: known customers with another checksum, and new ones.

    The same as :func:`upsert_changed` without what stays.  Of ``target`` only the ids and the checksum are
    read before the rows of changed customers are fetched.
    """
    latest = source.groupBy("FanID").agg(F.min(F.struct("Chksum", "PostcodeDistrict", "PostalArea")).alias("_new"))
    stale = target.select("FanID", "Chksum").join(latest, "FanID").where(F.col("_new.Chksum") != F.col("Chksum"))
    moved = target.join(stale.select("FanID").distinct(), "FanID", "left_semi")
    added = anti(anti(source, target, ["FanID"]), target, ["CINID"])
    return upsert_changed(moved, semi(source, moved, ["FanID"])).unionByName(
        added.withColumn("isNew", F.lit(1)).select(*target.columns)
    )


def upsert_changed_state(state: BucketedState, source: DataFrame, version: str, stage: Callable[[DataFrame, str], DataFrame]) -> list[int]:
    """The customer table as a bucketed state by ``FanID``: only buckets with a changed or new customer are rewritten.

    ``stage`` writes the changed rows, which are used twice.
    """
    return state.upsert(stage(changed_customers(state.read(), source), "changed-customers"), version)
