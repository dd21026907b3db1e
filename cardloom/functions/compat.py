"""Column helpers that keep the source database's rules for NULL, blank, text and hashes.

Plain Spark functions differ in small ways (``concat`` with NULL, ``nullif`` between
a number and '', age from two dates ...).  The decisions are made once, here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_key(c: Column | str) -> Column:
    """Comparison key of free text: case and trailing spaces do not count."""
    return F.upper(F.rtrim(_col(c)))


def blank_to_null(c: Column | str) -> Column:
    """NULL when the text is empty or only spaces; other text is left as it is."""
    c = _col(c)
    return F.when(F.rtrim(c) != "", c)


def trimmed_or_null(c: Column | str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return blank_to_null(F.trim(_col(c)))


def zero_to_null(c: Column | str) -> Column:
    """A number compared with '' is compared with 0, so 0 becomes NULL."""
    c = _col(c)
    return F.when(c != 0, c)


def base_date_to_null(c: Column | str) -> Column:
    """A date compared with '' is compared with 1900-01-01, so that day becomes NULL."""
    c = _col(c)
    return F.when(c != F.lit("1900-01-01").cast("date"), c)


def concat_blank(*cols: Column | str) -> Column:
    """Concatenation in which NULL counts as empty text."""
    return F.concat_ws("", *[_col(c).cast("string") for c in cols])


def concat_null(*cols: Column | str) -> Column:
    """Concatenation that is NULL as soon as one part is NULL."""
    return F.concat(*[_col(c).cast("string") for c in cols])


def text_length(c: Column | str) -> Column:
    """Length without trailing spaces."""
    return F.length(F.rtrim(_col(c)))


def text30(c: Column | str) -> Column:
    """A cast to text of unstated length keeps 30 characters."""
    return F.substring(_col(c).cast("string"), 1, 30)


def like_any(c: Column | str, patterns: tuple[str, ...]) -> Column:
    """Case-insensitive LIKE against any of the patterns (false when there are none)."""
    c = _col(c)
    hit = F.lit(False)
    for p in patterns:
        hit = hit | c.ilike(p)
    return hit


def text_in(c: Column | str, values: tuple[str, ...]) -> Column:
    """Membership in a list of literal texts; wildcards in the list are plain characters."""
    return text_key(c).isin([v.rstrip(" ").upper() for v in values])


def age_in_years(born: Column | str, on: Column | str) -> Column:
    """Calendar years between two dates, less one before the birthday of that year."""
    born, on = _col(born), _col(on)
    before = F.date_format(on, "MMdd") < F.date_format(born, "MMdd")
    return F.year(on) - F.year(born) - F.when(before, 1).otherwise(0)


def sha256_hex(c: Column | str) -> Column:
    """SHA-256 of the UTF-8 bytes as 64 upper-case hex digits (same bytes as a code page for ASCII)."""
    return F.upper(F.sha2(_col(c), 256))


def int32_base64(c: Column | str) -> Column:
    """Base64 of the four big-endian bytes of an integer."""
    wide = F.lpad(F.hex(_col(c).cast("long")), 16, "0")
    return F.base64(F.unhex(F.substring(wide, 9, 8)))


def half_hour(time: Column | str) -> Column:
    """``HH:mm:ss`` rounded down to the half hour; NULL stays NULL."""
    time = _col(time)
    minutes = F.substring(time, 4, 2)
    return F.concat(F.substring(time, 1, 2), F.when(minutes < "30", ":00:00").otherwise(":30:00"))


def time_text(ts: Column | str) -> Column:
    """Time of day of a timestamp as ``HH:mm:ss``."""
    return F.date_format(_col(ts), "HH:mm:ss")


def has_error_text(c: Column | str) -> Column:
    """True for lines with a traceback, or with "error" followed by a character that is not a letter."""
    c = _col(c)
    return F.coalesce(c.ilike("%traceback%") | c.rlike("(?i)error[^a-z]"), F.lit(False))
