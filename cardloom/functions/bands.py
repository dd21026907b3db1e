"""Age bands."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BandScheme:
    """Closed whole-number ranges with a label each; ``None`` means no upper end."""

    bands: tuple[tuple[int, int | None, object], ...]
    unknown: object


# The four age band schemes of the feeds.
AGE_NUMBER = BandScheme(
    bands=(
        (18, 24, 1),
        (25, 29, 2),
        (30, 39, 3),
        (40, 49, 4),
        (50, 59, 5),
        (60, 64, 6),
        (65, None, 7),
    ),
    unknown=0,
)
AGE_GROUP = BandScheme(
    bands=(
        (18, 24, "01. 18 to 24"),
        (25, 29, "02. 25 to 29"),
        (30, 39, "03. 30 to 39"),
        (40, 49, "04. 40 to 49"),
        (50, 59, "05. 50 to 59"),
        (60, 64, "06. 60 to 64"),
        (65, None, "07. 65+"),
    ),
    unknown="99. Unknown",
)
AGE_INSIGHT = BandScheme(
    bands=(
        (18, 24, "01. 18 to 24"),
        (25, 34, "02. 25 to 34"),
        (35, 44, "03. 35 to 44"),
        (45, 54, "04. 45 to 54"),
        (55, 64, "05. 55 to 64"),
        (65, None, "06. 65+"),
    ),
    unknown="99. Unknown",
)
AGE_DETAILED = BandScheme(
    bands=(
        (18, 24, "01. 18 to 24"),
        (25, 34, "02. 25 to 34"),
        (35, 44, "03. 35 to 44"),
        (45, 54, "04. 45 to 54"),
        (55, 64, "05. 55 to 64"),
        (65, 74, "06. 65 to 74"),
        (75, None, "07. 75+"),
    ),
    unknown="99. Unknown",
)


def band(value: Column | str, scheme: BandScheme) -> Column:
    """Label of the band that holds ``value``.

    NULL and values below the first band are unknown.  A fraction that falls
    between two bands belongs to none and gives NULL.
    """
    v = F.col(value) if isinstance(value, str) else value
    first = scheme.bands[0][0]
    label = F.when(v.isNull() | (v < first), F.lit(scheme.unknown))
    for low, high, name in scheme.bands:
        inside = v >= low if high is None else v.between(low, high)
        label = label.when(inside, F.lit(name))
    return label
