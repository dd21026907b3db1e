"""Customer, merchant, pseudonym, quarantine and direct-debit operators on edge rows."""

from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardloom.config import DirectDebitConfig, MerchantScope, NarrativeRules
from cardloom.operators import affinity, customer, direct_debit as dd, merchant, quarantine as q
from cardloom.operators.merchant import match_rules, without_matches
from tests.conftest import rows

AS_OF = datetime(2024, 3, 31, 4, 0, 0)


def test_customer_feed_keeps_every_id_and_blanks_zero(frame):
    ids = frame("CIN string, CINID int", ("S1", 1), ("S2", 2), ("S3", 3))
    people = frame(
        "FanID int, SourceUID string, Gender string, PostCode string, PostalSector string, PostCodeDistrict string,"
        " PostArea string, AgeCurrent int, Region string, RegistrationDate date, DeactivatedDate date",
        (11, "S1", " M ", "ab1 2cd", "AB1 2", "AB1", " ", 17, None, date(1900, 1, 1), None),
        (12, "S2", "  ", None, "AB1 2", "AB1", "AB", 40, "North", date(2020, 1, 1), date(2023, 1, 1)),
    )
    profile = customer.customer_profile(
        people,
        ids,
        frame("postcode string, acorncode2022 string, acorncode2023 string", ('"AB12CD"', '"1.A"', '" "')),
        frame("postcode string, CAMEO_CODE_GROUP string", ("AB1 2CD", "4")),
        frame("CAMEO_CODE_GROUP string, CAMEO_CODE_GROUP_Category string", ("4", "Rural")),
        frame("CINID int, microcell_id int", (1, 0)),
        frame("SourceUID string, EndDate date", ("S2", date(2024, 1, 1))),
        frame("cinid int", (9,)),
    )
    feed = {r["cinid"]: r for r in customer.customer_feed(ids, profile).collect()}
    first = feed[1]
    assert (first["gender"], first["postarea"], first["region"]) == ("M", None, "Unknown")
    assert (first["agecurrentbandnumber"], first["microcell_id"], first["RegistrationDate"]) == (None, None, None)
    assert (first["cameo_code_grp"], first["acorncode2022"], first["acorncode2023"]) == ("4-Rural", "1.A", None)
    assert [feed[i]["inprogram"] for i in (1, 2, 3)] == [1, 0, 0]
    assert feed[2]["gender"] is None and feed[2]["cameo_code_grp"] == "99. Unknown"
    assert feed[3]["insight_ageband"] == "99. Unknown" and feed[3]["agegroup"] is None


def test_exclusions(frame):
    people = frame("SourceUID string, CINID int", ("a", 1), ("b", 2), (None, 3))
    ended = frame("SourceUID string, EndDate date", ("a", date(2024, 1, 1)), ("b", None))
    none = frame("cinid int")
    assert rows(customer.exclude_customers(people, ended, none)) == [("a", 1)]
    assert rows(customer.exclude_customers(people, ended, open_only=False, null_aware=False)) == [(None, 3)]
    assert rows(customer.exclude_customers(people, ended, frame("cinid int", (None,)))) == []


MERCHANT = "ConsumerCombinationID int, BrandID int, MID string, Narrative string, LocationCountry string, MCCID int"


def test_narrative_rules(frame):
    df = frame(
        MERCHANT,
        (1, 1, "m", "Shop", " GB ", 1),
        (2, 1, "m", "SHOP%", "GB", 1),
        (3, 1, "m", "my spotify ab", "GB", 1),
        (4, 1, "m", "shop", "FR", 1),
        (5, 1, "9", "shop", "FR", 1),
        (6, 1, "m", "Uber  eats", "FR", 1),
        (7, 1, "44", "shop", "FR", 1),
        (8, 1, "m", "  break  ", "FR", 7),
        (9, 1, "m", "break", "FR", 8),
        (10, 1, "m", None, "GB", 1),
    )
    rules = NarrativeRules(
        excluded_exact=("SHOP%",),
        excluded_like=("%SPOTIFY%",),
        included_mids=("9",),
        included_like=("%UBER%EAT%",),
        included_prefixed_mids=("MID44",),
        included_narratives=("BREAK",),
        included_narrative_mccs=(7,),
    )
    assert [r[0] for r in rows(merchant.narrative_rules(df, rules).select("ConsumerCombinationID"))] == [1, 5, 6, 7, 8]


def test_scope_counts_a_merchant_once(frame):
    df = frame(MERCHANT, (1, 1, "m", "a", "GB", 7), (1, 1, "m", "a", "GB", 7), (2, 2, "m", "b", "GB", 7), (3, 9, "m", "c", "GB", 1))
    brands = frame("BrandID int, SectorID int", (1, 10), (2, 11), (9, 12))
    sectors = frame("SectorID int, SectorGroupID int", (10, 3), (11, 4))
    mcc = frame("MCCID int, MCC string", (7, "7"), (1, "1"))
    got = merchant.merchant_scope(df, brands, sectors, mcc, MerchantScope(sector_groups=(3,), brands=(9,), mccs=(7,)))
    assert [r[0] for r in rows(got)] == [1, 2]


def test_merchant_upsert(frame):
    target = frame(MERCHANT, (1, 1, "a,", "x", "GB", 1), (2, None, "b", "y", "GB", 1), (3, 3, "c", "z", "GB", 1))
    source = frame(MERCHANT, (1, 5, "a", "x", "GB", 1), (2, 6, "b", "y", "GB", 1), (3, None, "c", "z", "GB", 1), (4, 7, "d,1", "n,n", "GB", 1))
    got = {r[0]: r for r in rows(merchant.upsert_merchants(target, source))}
    assert [got[i][1] for i in (1, 2, 3, 4)] == [5, None, 3, 7]
    assert got[1][2] == "a," and got[4][2:4] == ("d1", "nn")
    again = merchant.upsert_merchants(merchant.upsert_merchants(target, source), source)
    assert rows(again) == sorted(got.values(), key=repr)


def test_narratives_differing_in_case_are_one(frame):
    df = frame("Narrative string", ("Shop",), ("SHOP ",), ("  ",), (None,), ("old",))
    cache = frame("Narrative string, NarrativeCleaned string", ("OLD", "OLD"))
    assert rows(merchant.clean_narratives_incremental(df, cache)) == [("SHOP ", "SHOP")]


def test_preferred_card_takes_the_lowest_club(frame):
    people = frame(
        "FanID int, CustomerGUID string, SourceUID string, CompositeID int, ClubID int, PostCodeDistrict string, PostArea string",
        (1, "g1", "S", 10, 12, "AB1", "AB"),
        (2, "g2", "S", 20, 11, "AB2", "AB"),
        (3, "g3", "T", 30, 11, "AB3", "AB"),
        (4, "g4", "U", 40, 99, "AB4", "AB"),
    )
    consents = frame("CustomerGUID string, AgreedTerms int", ("g1", 1), ("g2", 1), ("g2", 1), ("g3", 0), ("g4", 1))
    ids = frame("CIN string, CINID int", ("S", 1), ("T", 2), ("U", 3))
    got = affinity.preferred_card(people, ids, consents, (11, 12)).collect()
    assert [(r["FanID"], r["ClubID"], r["rw"]) for r in got] == [(2, 11, 1)]


def state_row(fan, cin, district, chk, new=0):
    return (fan, cin, district, "A", chk, new, "keep")


def test_change_upsert(frame):
    schema = "FanID int, CINID int, PostcodeDistrict string, PostalArea string, Chksum long, isNew int, SourceUID string"
    target = frame(schema, state_row(1, 1, "old", 1), state_row(2, 2, "old", 2), state_row(3, 3, "old", None), state_row(9, 9, "gone", 9, 1))
    source = frame(
        schema,
        (1, 1, "new", "B", 11, 0, "other"),
        (2, 2, "same", "B", 2, 0, "other"),
        (3, 3, "new", "B", 33, 0, "other"),
        (4, 4, "added", "B", 4, 0, "x"),
        (5, None, "added", "B", 5, 0, "x"),
        (6, 1, "known card", "B", 6, 0, "x"),
    )
    got = {r["FanID"]: r for r in affinity.upsert_changed(target, source).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 9}
    assert (got[1]["PostcodeDistrict"], got[1]["Chksum"], got[1]["SourceUID"]) == ("new", 11, "keep")
    assert got[2]["PostcodeDistrict"] == "old" and got[3]["PostcodeDistrict"] == "old"
    assert [got[i]["isNew"] for i in (1, 4, 5, 9)] == [0, 1, 1, 1]


def test_quarantine_holds(frame):
    base = "FileID int, RowNum int, CINID int, TranDate date, MID string, MCCID int, Narrative string, LocationCountry string,"
    tail = " Amount decimal(18,2), {} int, PaymentTypeID int, LocationID int"
    row = lambda i, cin: (1, i, cin, date(2024, 1, 1), "m,1", 5, "n", "GB", "O", Decimal("1.00"), 2, 1, 7)
    debit = frame(base + " OriginatorID string," + tail.format("CardholderPresentData"), row(1, 1), row(2, 2), row(3, 9), row(4, 1))
    credit = frame(base + " OriginatorReference string," + tail.format("CardholderPresentMc"), row(5, 1), row(6, 2))
    people = frame(
        "FanID int, CINID int, rw int, SourceUID string, PostalArea string, PostcodeDistrict string",
        (1, 1, 1, "S1", "AB", "AB1"),
        (2, 1, 1, "S2", "AB", "AB1"),
        (3, 2, 2, "S3", "AB", "AB1"),
    )
    log = frame("FileID int, RowNum int", (1, 4))
    held = q.hold_debit(debit, people, log)
    assert [r["RowNum"] for r in held.orderBy("RowNum").collect()] == [1, 2]
    credits = q.hold_credit(credit, people, log)
    assert [r["RowNum"] for r in credits.collect()] == [5, 5] and "CardholderPresentData" in credits.columns
    times = frame("FileID int, RowNum int, TransactionTime string", (1, 1, "10:59:00"))
    normal = q.normalise_quarantine(held, credits, people, frame("MCCID int, MCC string", (5, "5411")), times)
    got = sorted((r["RowNum"], r["FanID"], r["TranTime"], r["MID"]) for r in normal.where("RowNum = 1").collect())
    assert got == [(1, 1, "10:30:00", "m1"), (1, 2, "10:30:00", "m1")]
    assert normal.where("RowNum = 5").count() == 4


CONFIG = DirectDebitConfig(cutover=date(2024, 1, 1), grace_days=90, unbranded_brand=9)


@pytest.mark.parametrize(
    "left, day, kept",
    [
        (None, date(2030, 1, 1), True),
        (date(2023, 6, 1), date(2023, 5, 31), True),
        (date(2023, 6, 1), date(2023, 6, 1), False),
        (date(2024, 4, 1), date(2024, 1, 1), True),
        (date(2024, 4, 1), date(2024, 1, 2), False),
        (date(2024, 1, 1), date(2023, 10, 2), True),
        (date(2024, 1, 1), date(2023, 10, 3), False),
    ],
)
def test_dd_limit_dates(frame, left, day, kept):
    tx = frame("FileID int, RowNum int, FanID int, TranDate date", (1, 1, 1, day))
    people = frame("FanID int, DeactivatedDate date", (1, left))
    log = frame("FileID int, RowNum int", (5, 5))
    assert dd.dd_eligible(tx, people, log, CONFIG).count() == int(kept)


def test_dd_duplicates(frame):
    df = frame("CustomerGUID string, CINID int, x int", ("a", 1, 1), ("a", 2, 2), ("b", 3, 3), ("c", 4, 4), ("c", 4, 5), (None, 6, 6), (None, 7, 7))
    assert [r["x"] for r in dd.drop_max_id_duplicates(df).orderBy("x").collect()] == [1, 3, 6, 7]
    keyed = frame("key string, BrandID int, x int", ("k", 9, 1), ("k", 2, 2), ("l", 9, 3), ("m", 9, 4), ("m", 9, 5), ("n", None, 6), ("n", None, 7))
    got = dd.drop_unbranded_duplicates(keyed, "key", CONFIG.unbranded_brand)
    assert [r["x"] for r in got.orderBy("x").collect()] == [2, 3, 6, 7]


def test_dd_merchants_mask_only_known_brands(frame):
    merchants = frame(
        "ConsumerCombinationID_DD int, OIN int, Narrative_RBS string, BrandID int",
        (1, 10, "A, B", 1),
        (2, 20, "C, D", 2),
        (3, 30, "E, F", 3),
    )
    brands = frame("BrandID int, BrandName string", (1, "One"), (2, "Two"))
    mask = frame("BrandID int, BrandName string, MerchantNarrative string", (2, "Group", "Group, x"), (3, "Other", "Other"))
    got = dd.dd_merchants(merchants, brands, mask, keyed_by_id=True)
    assert rows(got) == sorted(
        [(1, 10, 1, "One", "A B"), (2, 20, 2, "Group", "Group x"), (3, 30, None, None, "E F")], key=repr
    )


def test_export_file_count(spark):
    counts = [dd.export_file_count(spark.range(n), rows_per_file=3).first()[0] for n in (0, 1, 3, 4)]
    assert counts == [0, 1, 1, 2]


def test_proxy_mapping_adds_customers_of_no_source(frame):
    people = frame("FanID int, CustomerGUID string, SourceUID string", (1, "g1", "S1"), (2, "g2", "S2"), (3, "g3", "S3"))
    ids = frame("CIN string, CINID int", ("S1", 1), ("S2", 2), ("S3", 3))
    earlier = frame("FanID int, CINID int, ProxyUserID binary", (1, 1, bytearray(b"\x0a")))
    got = dd.proxy_mapping(
        frame("FanID int, BankAccountID int", (1, 5), (1, 5)),
        people,
        ids,
        earlier,
        frame("FanID int, SourceUID string, ProxyUserID binary"),
        frame("CustomerGUID string, AccountGUID string"),
        frame("BankAccountID int, BankAccountGUID string", (5, "acc")),
        frame("CINID int, BankAccountGUID string"),
        frame("cinid int, neonproxyuserid string, bankaccountguid string", (7, "N", "x")),
        frame("SourceUID string, EndDate date", ("S3", date(2020, 1, 1))),
    )
    assert rows(got) == sorted([(1, "0A", "acc"), (2, None, None), (7, "N", "x")], key=repr)
    assert got.where(F.col("ProxyUserID") == 3).count() == 0


def test_rule_index_equals_the_chain(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcAB %_") for _ in range(rnd.randint(0, 7)))
    texts = [(i, rnd.choice([None, word(), word() + " shop " + word(), "10% off", "a\\b"])) for i in range(80)]
    patterns = ["%" + word() + "%" for _ in range(40)] + [word() for _ in range(20)] + ["%SHOP%", "", "%", "_", "10\\% %", "%a_b%", "shop", "%zzz%"]
    df = spark.createDataFrame(texts, "id int, Narrative string")
    rules = spark.createDataFrame([*enumerate(patterns), (99, None)], "rule int, pattern string")
    wanted = [r for i, p in enumerate(patterns) for r in df.where(F.col("Narrative").ilike(p)).select("id", F.lit(i)).collect()]
    assert rows(match_rules(df, rules, "Narrative", "id")) == sorted(map(tuple, wanted), key=repr)
    hit = {r[0] for r in wanted}
    assert [r["id"] for r in without_matches(df, rules, "Narrative", "id").orderBy("id").collect()] == [i for i, _ in texts if i not in hit]


def test_the_plan_does_not_grow_with_the_rules(spark, tmp_path):
    spark.range(2_000).select("id", F.concat(F.lit("merchant "), "id").alias("Narrative")).write.parquet(f"{tmp_path}/m")
    df, size = spark.read.parquet(f"{tmp_path}/m"), []
    for n in (10, 10_000):
        spark.range(n).select(F.col("id").alias("rule"), F.concat(F.lit("%ant "), F.col("id") + 1_000).alias("pattern")).write.parquet(f"{tmp_path}/r{n}")
        found = match_rules(df, spark.read.parquet(f"{tmp_path}/r{n}"), "Narrative", "id")
        size.append(len(found._jdf.queryExecution().optimizedPlan().toString().splitlines()))
        assert found.count() == min(n, 1_000)
    assert size[0] == size[1]

