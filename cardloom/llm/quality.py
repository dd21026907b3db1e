"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages, and only the bag is labelled.  Every passage is encoded from its
bytes, gated attention weighs the encodings, and their weighted mean is scored.  Encoder,
attention and classifier are trained together in numpy on a bounded sample of labelled
documents.  Scoring reads all passages of every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.language_id import windows
from cardloom.llm.learning import Adam, drawn, labelled_sample, sigmoid
from cardloom.llm.shared import blocks, spare_memory

PASSAGE = 512
PAIRS = 2048
EMBED = 12
HIDDEN = 24
ATTENTION = 16
PER_LABEL = 1000
EPOCHS = 14
SHORT_EVERY = 4
_LAGS = tuple(range(1, 21))


def _classes() -> np.ndarray:
    """A class for each byte: each mark, digits, capitals, small letters, white space, control and high bytes."""
    out = np.zeros(256, np.int64)
    for b in range(1, 256):
        c = chr(b)
        if b >= 128:
            out[b] = 1
        elif c.islower():
            out[b] = 2
        elif c.isupper():
            out[b] = 3
        elif c.isdigit():
            out[b] = 4
        elif c == " ":
            out[b] = 5
        elif c == "\n":
            out[b] = 6
        elif b < 32 or b == 127:
            out[b] = 7
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    out[marks] = np.arange(8, 8 + len(marks))
    return out


_CLASS = _classes()
CLASSES = int(_CLASS.max()) + 1
STATS = CLASSES - 1 + 8


def pair_codes(x: np.ndarray) -> np.ndarray:
    """Hashed pairs of neighbouring bytes of passages (rows, width), 0 where one is filling."""
    a = x[:, :-1].astype(np.uint32)
    b = x[:, 1:]
    code = ((a * np.uint32(257) + b) * np.uint32(2654435761) >> np.uint32(21)) % np.uint32(PAIRS - 1) + np.uint32(1)
    return np.where((a > 0) & (b > 0), code, 0).astype(np.int64)


def statistics(x: np.ndarray) -> np.ndarray:
    """Shares of byte classes, of bytes repeated at distances up to a word, and of distinct runs of four; class changes and fill."""
    rows, width = x.shape
    filled = np.maximum((x > 0).sum(1), 1)
    flat = _CLASS[x] + np.arange(rows)[:, None] * CLASSES
    share = np.bincount(flat.ravel(), minlength=rows * CLASSES).reshape(rows, CLASSES)[:, 1:] / filled[:, None]
    same = np.empty((rows, len(_LAGS)))
    echo = np.zeros(x.shape, bool)
    for n, k in enumerate(_LAGS):
        equal = (x[:, k:] == x[:, :-k]) & (x[:, k:] > 0)
        same[:, n] = equal.sum(1) / filled
        echo[:, k + 2 :] |= equal[:, 2:] & equal[:, 1:-1] & equal[:, :-2]
    # One letter over and over, words over and over, how much that stands out, and runs of three heard shortly before.
    again = np.sort(same[:, 2:], axis=1)
    heard = echo.sum(1) / filled
    repeats = np.column_stack([same[:, 0], same[:, 1], again[:, -1], again[:, -1] - again[:, len(_LAGS) // 2], heard])
    y = x.astype(np.uint32)
    four = np.sort(y[:, :-3] | y[:, 1:-2] << np.uint32(8) | y[:, 2:-1] << np.uint32(16) | y[:, 3:] << np.uint32(24), axis=1)
    distinct = ((four[:, 1:] != four[:, :-1]) & (four[:, 1:] > 0)).sum(1) / np.maximum(filled - 3, 1)
    kinds = np.minimum(_CLASS[x], 8)
    changes = ((kinds[:, 1:] != kinds[:, :-1]) & (x[:, 1:] > 0)).sum(1) / filled
    out = np.column_stack([np.sqrt(share), 3 * repeats, 2 * distinct, changes, np.log1p(filled) / np.log1p(width)])
    return out.astype(np.float32)


def new_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    return {
        "e": rng.normal(0, 0.3, (PAIRS, EMBED)).astype(np.float32),
        "w": rng.normal(0, 1 / np.sqrt(EMBED + STATS), (EMBED + STATS, HIDDEN)).astype(np.float32),
        "b": np.zeros(HIDDEN, np.float32),
        "v": rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, ATTENTION)).astype(np.float32),
        "u": rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, ATTENTION)).astype(np.float32),
        "a": rng.normal(0, 1 / np.sqrt(ATTENTION), ATTENTION).astype(np.float32),
        "c": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN).astype(np.float32),
        "d": np.zeros(1, np.float32),
    }


def features(w: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encoder inputs (rows, EMBED + STATS) and the pair codes."""
    codes = pair_codes(x)
    size = np.maximum((codes > 0).sum(1), 1)
    table = w["e"].copy()
    table[0] = 0
    mean = np.empty((len(x), EMBED), np.float32)
    for i in range(0, len(x), 64):
        mean[i : i + 64] = table[codes[i : i + 64]].sum(1)
    return np.concatenate([mean / size[:, None].astype(np.float32) * np.float32(4), statistics(x)], 1), codes


def encode(w: dict, inputs: np.ndarray) -> np.ndarray:
    return np.tanh(inputs @ w["w"] + w["b"])


def attention(w: dict, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gated attention logits of passages, with both factors."""
    t, g = np.tanh(h @ w["v"]), sigmoid(h @ w["u"])
    return (t * g) @ w["a"], t, g


def pool(logits: np.ndarray, h: np.ndarray, owner: np.ndarray, bags: int) -> tuple[np.ndarray, np.ndarray]:
    """Attention weights per passage and the weighted mean encoding per bag."""
    top = np.full(bags, -np.inf)
    np.maximum.at(top, owner, logits)
    e = np.exp(logits - top[owner])
    total = np.bincount(owner, e, bags)
    weight = e / np.maximum(total, 1e-30)[owner]
    z = np.zeros((bags, h.shape[1]))
    np.add.at(z, owner, weight[:, None] * h)
    return weight, z


def loss_and_gradients(w: dict, x: np.ndarray, owner: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean log loss of bags, and its gradients; x: passages, owner: their bags."""
    inputs, codes = features(w, x)
    h = encode(w, inputs)
    logits, t, g = attention(w, h)
    weight, z = pool(logits, h, owner, len(y))
    p = sigmoid(z @ w["c"] + w["d"])
    loss = -float(np.mean(np.log(np.where(y == 1, p, 1 - p) + 1e-9)))
    ds = (p - y) / len(y)
    grads = {"c": z.T @ ds, "d": ds.sum(keepdims=True)}
    dz = np.outer(ds, w["c"])[owner]
    dweight = (dz * h).sum(1)
    mean = np.bincount(owner, weight * dweight, len(y))
    dlogit = weight * (dweight - mean[owner])
    grads["a"] = (t * g).T @ dlogit
    dt = np.outer(dlogit, w["a"]) * g * (1 - t * t)
    dg = np.outer(dlogit, w["a"]) * t * g * (1 - g)
    grads["v"], grads["u"] = h.T @ dt, h.T @ dg
    dh = weight[:, None] * dz + dt @ w["v"].T + dg @ w["u"].T
    dpre = dh * (1 - h * h)
    grads["w"], grads["b"] = inputs.T @ dpre, dpre.sum(0)
    size = np.maximum((codes > 0).sum(1), 1)
    dmean = (dpre @ w["w"].T)[:, :EMBED] * (4 / size)[:, None]
    # How often each pair stands in each passage, summed over passages by one product per block.
    de = np.zeros_like(w["e"])
    for i in range(0, len(x), 64):
        block = codes[i : i + 64]
        held = np.bincount((block + np.arange(len(block))[:, None] * PAIRS).ravel(), minlength=len(block) * PAIRS)
        de += held.reshape(len(block), PAIRS).T.astype(np.float32) @ dmean[i : i + 64].astype(np.float32)
    de[0] = 0
    grads["e"] = de
    return loss, grads


class Model:
    """Trained weights; without any, every score is ``base``."""

    def __init__(self, weights: dict[str, np.ndarray] | None, base: float = 0.5):
        self.weights, self.base = weights, base

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1 for each text; NULL and empty texts are one empty passage."""
        if self.weights is None:
            return np.full(len(texts), self.base)
        x, count = windows([t or "" for t in texts], PASSAGE)
        if (count == 0).any():
            at = np.repeat(np.cumsum(count)[count == 0], 1)
            x = np.insert(x, at, 0, axis=0)
            count = np.maximum(count, 1)
        h = np.concatenate([encode(self.weights, features(self.weights, x[i : i + 1024])[0]) for i in range(0, len(x), 1024)])
        _, z = pool(attention(self.weights, h)[0], h, np.repeat(np.arange(len(texts)), count), len(texts))
        return np.clip(sigmoid(z @ self.weights["c"] + self.weights["d"]), 0.0, 1.0)


def fit(sample: list[tuple[int, str]], epochs: int = EPOCHS, batch: int = 64, seed: int = 3) -> Model:
    """Train on (label, text) pairs.  With one label or none there is nothing to learn and the score is constant."""
    y = np.array([int(k == 1) for k, _ in sample])
    if not len(y) or y.min() == y.max():
        return Model(None, float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    # Short texts are rare in the sample, so a few words of every fourth text of either label stand for them.
    words = [(int(k == 1), t.split(" ")) for k, t in sample if t][:: SHORT_EVERY]
    few = [(k, " ".join(w[(i := int(rng.integers(len(w)))) : i + int(rng.integers(1, 12))])) for k, w in words]
    sample = [*sample, *few]
    y = np.append(y, [k for k, _ in few]).astype(int)
    x, count = windows([t or "" for _, t in sample], PASSAGE)
    ends = np.cumsum(count)
    w = new_weights(rng)
    w["d"][0] = np.log(y.mean() / (1 - y.mean()))
    adam = Adam(w, 0.01)
    usable = np.flatnonzero(count)
    for epoch in range(epochs):
        order = rng.permutation(usable)
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            at = np.concatenate([np.arange(ends[k] - count[k], ends[k]) for k in pick])
            _, grads = loss_and_gradients(w, x[at], np.repeat(np.arange(len(pick)), count[pick]), y[pick])
            adam.step(grads, 1.0 if epoch < epochs * 0.6 else 0.25)
    return Model({k: v.astype(np.float32) for k, v in w.items()})


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", per_label: int = PER_LABEL) -> Model:
    """Fit on about ``per_label`` labelled documents of each label (0 and 1), a bounded sample chosen by key.

    Of documents of over 4,096 characters eight slices of 512 are taken.  A run of 1 to 11 words of every ``SHORT_EVERY``-th
    document is added with the document's label.

    Rows of ``labels`` without a label of 0 or 1 are left out; a key labelled more than once
    takes its smallest label.  The keys are chosen first, so that no text is shuffled; they are
    bounded and broadcast.
    """
    marks = labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias("_y"))
    chosen, most = drawn(docs.select(key).join(marks, key), "_y", key, per_label)
    keys = chosen.select(key, "_y").distinct().limit(most)
    rows = docs.select(key, text).join(F.broadcast(keys), key)
    return fit(labelled_sample(rows, "_y", text, key, 2 * per_label, 8, PASSAGE))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text (0 to 1); a column of that name is replaced.

    NULL and empty texts are scored as one empty passage; rows stay as they are.
    """
    kept = [c for c in docs.columns if c != out]

    @F.pandas_udf("double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            texts = s.tolist()
            parts = [model.score(texts[a:b]) for a, b in blocks(texts)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="float64")
        spare_memory()

    return docs.select(*kept, apply(F.col(text)).alias(out))
