"""Values a deployment supplies: id lists, patterns and limits.

None of the business lists (brands, clubs, merchant categories, bank groups) is
built in.  They come in as values of these classes or as small tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta


@dataclass(frozen=True)
class NarrativeRules:
    """Rules that decide which scoped merchants are kept."""

    excluded_exact: tuple[str, ...] = ()
    excluded_like: tuple[str, ...] = ()
    home_countries: tuple[str, ...] = ("GB",)
    included_mids: tuple[str, ...] = ()
    included_like: tuple[str, ...] = ()
    included_prefixed_mids: tuple[str, ...] = ()
    included_narratives: tuple[str, ...] = ()
    included_narrative_mccs: tuple[int, ...] = ()


@dataclass(frozen=True)
class MerchantScope:
    """Which merchants belong to the scoped feed."""

    sector_groups: tuple[int, ...] = ()
    brands: tuple[int, ...] = ()
    mccs: tuple[int, ...] = ()


@dataclass(frozen=True)
class AffinityConfig:
    """Clubs and the secret number used for customer pseudonyms."""

    primary_clubs: tuple[int, ...]
    secondary_clubs: tuple[int, ...]
    pseudonym_offset: int


@dataclass(frozen=True)
class DirectDebitConfig:
    """Dates and ids of the direct-debit feed."""

    cutover: date
    grace_days: int = 90
    unbranded_brand: int = 0
    publisher: int = 1


@dataclass(frozen=True)
class RunContext:
    """The clock reading and id of one run; nothing else reads a clock."""

    run_id: str
    as_of: datetime

    @property
    def today(self) -> date:
        return self.as_of.date()

    @property
    def load_date(self) -> date:
        return load_date(self.as_of)


def load_date(as_of: datetime, hours_back: int = 6) -> date:
    """The business date of a run: runs before 06:00 belong to the day before."""
    return (as_of - timedelta(hours=hours_back)).date()
