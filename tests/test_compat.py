"""Column helpers: one test per rule of the source database that Spark does not share."""

from __future__ import annotations

import base64
import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from cardloom.functions import bands, compat, keys
from tests.conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def text(v):
    return F.lit(v).cast("string")


def test_number_and_date_blanks(spark):
    assert one(spark, compat.zero_to_null(F.lit(0))) is None
    assert one(spark, compat.zero_to_null(F.lit(7))) == 7
    assert one(spark, compat.base_date_to_null(F.lit(date(1900, 1, 1)))) is None
    assert one(spark, compat.base_date_to_null(F.lit(date(1900, 1, 2)))) == date(1900, 1, 2)


def test_concatenation_with_null(spark):
    parts = (F.lit("a"), text(None), F.lit("b"))
    assert one(spark, compat.concat_blank(*parts)) == "ab"
    assert one(spark, compat.concat_null(*parts)) is None


def test_text_comparison_ignores_case_and_trailing_spaces(spark):
    assert one(spark, compat.text_key(F.lit("aB  ")) == compat.text_key(F.lit("Ab")))
    assert not one(spark, compat.text_key(F.lit(" ab")) == compat.text_key(F.lit("ab")))
    assert one(spark, compat.text_length(F.lit(" a  "))) == 2
    assert one(spark, compat.blank_to_null(F.lit("   "))) is None
    assert one(spark, compat.blank_to_null(F.lit(" x "))) == " x "
    assert one(spark, compat.trimmed_or_null(F.lit(" M "))) == "M"


def test_unsized_cast_keeps_thirty_characters(spark):
    assert one(spark, compat.text30(F.lit("x" * 40))) == "x" * 30


def test_listed_wildcards_are_literal(spark):
    assert not one(spark, compat.text_in(F.lit("RED PLATE"), ("RED%",)))
    assert one(spark, compat.text_in(F.lit("red% "), ("RED%",)))
    assert one(spark, compat.like_any(F.lit("just a eat"), ("%JUST%EAT%",)))
    assert not one(spark, compat.like_any(F.lit("x"), ()))


@pytest.mark.parametrize(
    "born, on, age",
    [
        (date(2000, 2, 29), date(2023, 2, 28), 22),
        (date(2000, 2, 29), date(2023, 3, 1), 23),
        (date(1990, 5, 10), date(2020, 5, 9), 29),
        (date(1990, 5, 10), date(2020, 5, 10), 30),
        (date(1990, 5, 10), date(2020, 5, 11), 30),
        (None, date(2020, 5, 11), None),
    ],
)
def test_age(spark, born, on, age):
    assert one(spark, compat.age_in_years(F.lit(born).cast("date"), F.lit(on))) == age


@pytest.mark.parametrize("n", [0, 1, 255, 1_000_000, -1, -2_147_483_648])
def test_int_base64_is_four_big_endian_bytes(spark, n):
    expected = base64.b64encode(n.to_bytes(4, "big", signed=True)).decode()
    assert one(spark, compat.int32_base64(F.lit(n))) == expected


@pytest.mark.parametrize(
    "time, floor",
    [
        ("09:00:00", "09:00:00"),
        ("09:29:59", "09:00:00"),
        ("09:30:00", "09:30:00"),
        ("23:59:59", "23:30:00"),
        (None, None),
    ],
)
def test_half_hour(spark, time, floor):
    assert one(spark, compat.half_hour(text(time))) == floor


@pytest.mark.parametrize(
    "line, error",
    [
        ("Traceback (most recent)", True),
        ("ERROR: x", True),
        ("last Error", False),
        ("ErrorX", False),
        ("error 5", True),
        (None, False),
    ],
)
def test_error_text(spark, line, error):
    assert one(spark, compat.has_error_text(text(line))) is error


AGES = [None, 17, 18, 24, 25, 29, 30, 34, 35, 59, 60, 64, 65, 74, 75]


@pytest.mark.parametrize(
    "scheme, labels",
    [
        (bands.AGE_NUMBER, [0, 0, 1, 1, 2, 2, 3, 3, 3, 5, 6, 6, 7, 7, 7]),
        (bands.AGE_GROUP, ["99", "99", "01", "01", "02", "02", "03", "03", "03", "05", "06", "06", "07", "07", "07"]),
        (bands.AGE_INSIGHT, ["99", "99", "01", "01", "02", "02", "02", "02", "03", "05", "05", "05", "06", "06", "06"]),
        (bands.AGE_DETAILED, ["99", "99", "01", "01", "02", "02", "02", "02", "03", "05", "05", "05", "06", "06", "07"]),
    ],
)
def test_bands(spark, scheme, labels):
    got = [one(spark, bands.band(F.lit(a).cast("int"), scheme)) for a in AGES]
    assert [g if isinstance(g, int) else g[:2] for g in got] == labels


def test_fraction_between_bands_has_no_label(spark):
    assert one(spark, bands.band(F.lit(24.5), bands.AGE_INSIGHT)) is None


@pytest.mark.parametrize(
    "postcode, key, sector",
    [
        ("ab1 2cd", "AB12CD", "ab1 2"),
        ('"AB1 2CD" ', "AB12CD", '"AB1 2'),
        ("AB12CD", "AB12CD", "AB12CD A"),
        ("", "", " "),
        (None, None, " "),
    ],
)
def test_postcodes(spark, postcode, key, sector):
    assert one(spark, keys.postcode_key(text(postcode))) == key
    assert one(spark, keys.postal_sector(text(postcode))) == sector


def test_sequence_id_and_codes(spark):
    assert one(spark, keys.tran_sequence_id(1, F.lit(5), F.lit(9))) == "1-5-9"
    assert one(spark, keys.coded_label(F.lit("3"), F.lit("Rural"))) == "3-Rural"
    assert one(spark, keys.coded_label(text(None), F.lit("Rural"))) == "99. Unknown"
    codes = {0: "P", 1: "U", 2: "C", 3: "C", 4: "R", 5: "E", 9: "N", 7: "Unknown", None: "Unknown"}
    assert {c: one(spark, keys.terminal_type(F.lit(c).cast("int"))) for c in codes} == codes
    assert [one(spark, keys.card_type(F.lit(p).cast("int"))) for p in (1, 2, 3, None)] == ["D", "C", "U", "U"]


@pytest.mark.parametrize(
    "postcode, first, second",
    [
        ("AB1 2CD", "MID1A2SHOPAB12", "MID1,A2SHOPAB12"),
        ("AB1", "MID1A2SHOPA", "MID1,A2SHOPA"),
        ("AB", "MID1A2SHOP", "MID1,A2SHOP"),
        ("A", "MID1A2SHOP", "MID1,A2SHOP"),
        (" - -", "MID1A2SHOP", "MID1,A2SHOP-"),
        (None, "MID1A2SHOP", "MID1,A2SHOP"),
    ],
)
def test_combo_ids(spark, postcode, first, second):
    args = (F.lit("1,a2"), F.lit("shop"), text(postcode))
    assert one(spark, keys.combo_id(*args)) == first
    assert one(spark, keys.combo_id_spaceless(*args)) == second


def test_combo_id_is_null_without_mid_or_narrative(spark):
    assert one(spark, keys.combo_id(text(None), F.lit("x"), F.lit("AB1 2CD"))) is None
    assert one(spark, keys.combo_id_spaceless(F.lit("1"), text(None), F.lit("AB1 2CD"))) is None


def test_hashes(spark):
    full = hashlib.sha256(b"GBSHOPO15411").hexdigest().upper()
    got = one(spark, keys.merchant_tuple_hash(F.lit("GB"), F.lit("SHOP"), F.lit("O1"), F.lit("5411"), text(None)))
    assert got == full
    key = one(spark, keys.dd_tuple_key(F.lit("WATER"), F.lit("123")))
    assert key == hashlib.sha256(b"WATER123").hexdigest().upper()[2:] and len(key) == 62
    proxy = one(spark, keys.proxy_user_hash(F.lit(10), F.lit("S1"), 5))
    assert bytes(proxy) == hashlib.sha256(b"15,S1").digest()
    empty = one(spark, keys.proxy_user_hash(F.lit(10), text(None), 5))
    assert bytes(empty) == hashlib.sha256(b"15,").digest()


def test_checksum_tells_null_positions_apart(frame):
    df = frame("a int, b int", (None, 1), (1, None), (1, 1))
    sums = [r["s"] for r in df.select(keys.row_checksum("a", "b").alias("s")).collect()]
    assert len(set(sums)) == 3


def test_address_text(spark):
    got = one(spark, keys.address_text(F.lit("Flat 1"), F.lit(""), F.lit("The Mill"), F.lit("ab1 2cd")))
    assert got == '"FLAT1","THEMILL","AB12CD"'
    assert one(spark, keys.address_text(text(None), F.lit("5"), F.lit(""), F.lit("AB1 2CD"))) is None


def test_narrative_cleaning(frame):
    df = frame("n string", ("  Shop*No.1 -- Leeds ",), ("ok",))
    assert rows(df.select(keys.clean_narrative("n").alias("c"))) == [("OK",), ("SHOP NO 1 LEEDS",)]
