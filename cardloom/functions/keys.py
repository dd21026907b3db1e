"""Keys, hashes and codes derived from one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardloom.functions.compat import (
    blank_to_null,
    concat_blank,
    concat_null,
    int32_base64,
    sha256_hex,
    text30,
    text_length,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tran_sequence_id(publisher: int, file_id: Column | str, row_num: Column | str) -> Column:
    """``publisher-file-row``; a NULL part is left empty."""
    return concat_blank(F.lit(publisher), F.lit("-"), file_id, F.lit("-"), row_num)


def postcode_key(postcode: Column | str) -> Column:
    """Upper-case postcode without surrounding quotes and without spaces."""
    return F.replace(F.btrim(F.upper(_col(postcode)), F.lit("\" ")), F.lit(" "), F.lit(""))


def postal_sector(postcode: Column | str) -> Column:
    """Outward code, a space and the first inward character.

    A postcode without a space is taken whole, followed by its own first character.
    """
    p = _col(postcode)
    gap = F.instr(p, " ")
    outward = F.substring_index(p, " ", 1)
    return concat_blank(outward, F.lit(" "), F.substring(p, gap + 1, F.lit(1)))


def coded_label(code: Column | str, category: Column | str) -> Column:
    """``code-category``, or unknown when either is missing."""
    return F.coalesce(concat_null(code, F.lit("-"), category), F.lit("99. Unknown"))


def unquoted(c: Column | str) -> Column:
    """Text without surrounding double quotes."""
    return F.btrim(_col(c), F.lit('"'))


def alphanumeric(c: Column | str) -> Column:
    """Letters and digits only."""
    return F.regexp_replace(_col(c).cast("string"), "[^A-Za-z0-9]", "")


def digits(c: Column | str) -> Column:
    """Digits only."""
    return F.regexp_replace(_col(c), "[^0-9]", "")


def without_commas(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit(","), F.lit(""))


def clean_narrative(c: Column | str) -> Column:
    """Default narrative cleaning: upper case, punctuation to spaces, single spaces, trimmed."""
    spaced = F.regexp_replace(F.upper(_col(c)), "[^A-Z0-9]+", " ")
    return F.trim(spaced)


def combo_id(mid: Column | str, narrative: Column | str, postcode: Column | str) -> Column:
    """Merchant combination id: cleaned MID, narrative and the postcode without its last two characters.

    NULL when the MID or the narrative is NULL; a missing or short postcode adds nothing.
    """
    plain = alphanumeric(postcode)
    area = F.substring(plain, F.lit(1), F.greatest(F.length(plain) - 2, F.lit(0)))
    tail = F.when(text_length(postcode) > 2, area).otherwise("")
    return F.upper(concat_null(F.lit("MID"), text30(alphanumeric(mid)), narrative, tail))


def combo_id_spaceless(mid: Column | str, narrative: Column | str, postcode: Column | str) -> Column:
    """Second form of the combination id: raw MID, all spaces removed, two characters are enough."""
    p = _col(postcode)
    area = F.substring(p, F.lit(1), F.greatest(text_length(p) - 2, F.lit(0)))
    tail = F.when(text_length(p) >= 2, area).otherwise("")
    joined = F.upper(concat_null(F.lit("MID"), text30(mid), narrative, tail))
    return F.replace(joined, F.lit(" "), F.lit(""))


def merchant_tuple_hash(*parts: Column | str) -> Column:
    """Hash of country, narrative, originator, category code and MID; NULL parts count as empty."""
    return sha256_hex(concat_blank(*parts))


def dd_tuple_key(narrative: Column | str, oin: Column | str) -> Column:
    """Direct-debit merchant key: the hash without its first byte, 62 hex digits."""
    return F.substring(sha256_hex(concat_null(narrative, oin)), 3, 64)


def dd_oin_base64(oin: Column | str) -> Column:
    """Originator number in the feed's base64 form."""
    return int32_base64(oin)


def proxy_user_hash(fan_id: Column | str, source_uid: Column | str, offset: int) -> Column:
    """Customer pseudonym: 32 hash bytes of the shifted customer id and the source id."""
    shifted = _col(fan_id) + F.lit(offset)
    return F.unhex(F.sha2(concat_blank(shifted, F.lit(","), source_uid), 256))


def row_checksum(*cols: Column | str) -> Column:
    """64-bit change detector; every column carries its own NULL mark."""
    marked = []
    for c in cols:
        c = _col(c)
        marked += [c.isNull(), c]
    return F.xxhash64(*marked)


def address_text(sub_name: Column | str, number: Column | str, name: Column | str, postcode: Column | str) -> Column:
    """Canonical address text, NULL when the sub-building name or both house fields are NULL."""
    house = F.coalesce(blank_to_null(number), _col(name))
    q = F.lit('"')
    text = concat_null(q, sub_name, F.lit('","'), house, F.lit('","'), postcode, q)
    return F.upper(F.replace(text, F.lit(" "), F.lit("")))


def card_type(payment_type: Column | str) -> Column:
    """D for debit, C for credit, U for anything else."""
    p = _col(payment_type)
    return F.when(p == 1, "D").when(p == 2, "C").otherwise("U")


# Terminal letter of each cardholder-present code.
TERMINAL_TYPES = {0: "P", 1: "U", 2: "C", 3: "C", 4: "R", 5: "E", 9: "N"}


def terminal_type(code: Column | str) -> Column:
    """Terminal letter of a cardholder-present code; other codes and NULL are Unknown."""
    c = _col(code)
    letter = F.when(c.isNull(), "Unknown")
    for value, name in TERMINAL_TYPES.items():
        letter = letter.when(c == value, name)
    return letter.otherwise("Unknown")
