"""What the two learned operators share: bounded labelled samples and a gradient step."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.shared import staged

LABELS = 256
#: So many that a label is hardly ever without a drawn row.
LEAST_ROWS = 16


def slices(text: Column, count: int, chars: int) -> Column:
    """The text, or, if it is longer than ``count * chars``, that many evenly spaced slices of it joined.

    Only for fitting on a bounded sample; scoring reads whole texts.
    """
    length = F.char_length(text)
    step = (length - chars) / (count - 1)
    cut = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.substring(text, (F.floor(i * step) + 1).cast("int"), F.lit(chars)))
    return F.when(length <= count * chars, text).otherwise(F.array_join(cut, ""))


def drawn(rows: DataFrame, label: str, key: str, per_label: int) -> tuple[DataFrame, int]:
    """About ``per_label`` rows of every label with their draw ``_u``, and a bound on their number.

    With more than ``LABELS`` labels each gets fewer, so that the whole stays as large, but at least ``LEAST_ROWS``.
    Rows are chosen by a hash of their key, so the same rows give the same sample; a label with no
    more rows than that is taken whole.
    """
    rows = rows.where(F.col(label).isNotNull())
    sizes = staged(rows.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_rows")), "label-sizes")
    labels = sizes.count()
    per_label = min(per_label, max(LEAST_ROWS, per_label * LABELS // max(1, labels)))
    bound = F.when(F.col("_rows") > per_label, 1.25 * per_label / F.col("_rows")).otherwise(2.0)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(7), F.col(key)), 11) / F.lit(float(2**53))
    chosen = rows.withColumn("_u", draw).join(sizes, F.col(label) == F.col("_label")).where(F.col("_u") < bound)
    return chosen.drop("_label", "_rows"), 2 * per_label * labels


def labelled_sample(rows: DataFrame, label: str, text: str, key: str, per_label: int, count: int, chars: int) -> list[tuple]:
    """A bounded sample of (label, slices of text); labels and their counts, and the sample, are all that reaches the driver."""
    chosen, most = drawn(rows.select(label, key, text).where(F.col(text).isNotNull()), label, key, per_label)
    if not most:
        return []
    chosen = chosen.select(F.col(label), slices(F.col(text), count, chars).alias("t"), "_u")
    return [(r[0], r[1]) for r in chosen.orderBy("_u", "t").limit(most).collect()]


class Adam:
    """Adam steps on a dict of arrays."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.n = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, grads: dict[str, np.ndarray], scale: float = 1.0) -> None:
        self.n += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        clip = min(1.0, 5.0 / (norm + 1e-12))
        for k, g in grads.items():
            g = g * clip
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.01 * (g * g - self.square[k])
            m = self.mean[k] / (1 - 0.9**self.n)
            v = self.square[k] / (1 - 0.99**self.n)
            self.weights[k] -= (self.rate * scale * m / (np.sqrt(v) + 1e-7)).astype(self.weights[k].dtype)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)
