"""Language identification by a bidirectional gated recurrent network over bytes.

Two recurrent units read each window of bytes from both ends and label every position; the
probabilities of all positions that belong to letters are averaged over the document.  The
network is trained in numpy by backpropagation through time on a bounded sample.
Scoring reads every byte of every text in windows that run through the network together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.learning import Adam, labelled_sample, sigmoid
from cardloom.llm.shared import blocks, free_name, spare_memory

UNKNOWN = "und"
HIDDEN = 8
WINDOW = 128
PER_LANGUAGE = 300
STEPS = 260
_ASCII = re.compile("[A-Za-z]")
_LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII.search(text) is not None or any(map(str.isalpha, text)))


def windows(texts: list[str], width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts cut to windows (windows, width), filled with zeros, and the windows per text."""
    data = [t.encode("utf-8", "replace") for t in texts]
    count = np.array([-(-len(d) // width) for d in data], np.int64)
    joined = b"".join(d.ljust(n * width, b"\0") for d, n in zip(data, count.tolist()))
    return np.frombuffer(joined, np.uint8).reshape(-1, width), count


def new_weights(classes: int, hidden: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    w = {}
    for side in "fb":
        w[f"x{side}"] = rng.normal(0, 0.3, (256, 3 * hidden))
        w[f"u{side}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
        w[f"m{side}"] = np.zeros(hidden)
        w[f"v{side}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, classes))
    w["c"] = np.zeros(classes)
    return w


def forward(w: dict, side: str, x: np.ndarray) -> tuple[np.ndarray, list]:
    """States (time, rows, hidden) of one direction over x (time, rows), in reading order, and what the way back needs."""
    hidden = len(w[f"m{side}"])
    h = np.zeros((x.shape[1], hidden))
    states, kept = np.empty((*x.shape, hidden)), []
    for t in range(len(x)):
        g, u = w[f"x{side}"][x[t]], h @ w[f"u{side}"]
        z = sigmoid(g[:, :hidden] + u[:, :hidden])
        r = sigmoid(g[:, hidden : 2 * hidden] + u[:, hidden : 2 * hidden])
        m = u[:, 2 * hidden :] + w[f"m{side}"]
        n = np.tanh(g[:, 2 * hidden :] + r * m)
        kept.append((h, z, r, m, n))
        h = n + z * (h - n)
        states[t] = h
    return states, kept


def backward(w: dict, side: str, x: np.ndarray, kept: list, dout: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of one direction, through time."""
    hidden = len(w[f"m{side}"])
    du, dm_sum = np.zeros_like(w[f"u{side}"]), np.zeros(hidden)
    dx = np.empty((*x.shape, 3 * hidden))
    dh = np.zeros((x.shape[1], hidden))
    for t in range(len(x) - 1, -1, -1):
        h, z, r, m, n = kept[t]
        dh = dh + dout[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * m * r * (1 - r)
        dm = dn * r
        d = np.concatenate([dz, dr, dm], 1)
        du += h.T @ d
        dm_sum += dm.sum(0)
        dx[t] = np.concatenate([dz, dr, dn], 1)
        dh = dh * z + d @ w[f"u{side}"].T
    table = np.zeros_like(w[f"x{side}"])
    np.add.at(table, x.ravel(), dx.reshape(-1, 3 * hidden))
    return {f"x{side}": table, f"u{side}": du, f"m{side}": dm_sum}


def loss_and_gradients(w: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy of the labels of all letter positions of x (rows, time), and its gradients."""
    xt = x.T
    sf, kf = forward(w, "f", xt)
    sb, kb = forward(w, "b", xt[::-1])
    back = sb[::-1]
    logits = sf @ w["vf"] + back @ w["vb"] + w["c"]
    logits -= logits.max(2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(2, keepdims=True)
    mask = _LETTER[xt]
    total = max(1, int(mask.sum()))
    rows = np.arange(len(y))
    loss = -float((np.log(p[:, rows, y] + 1e-12) * mask).sum()) / total
    d = p.copy()
    d[:, rows, y] -= 1
    d *= mask[:, :, None] / total
    grads = {"c": d.sum((0, 1)), "vf": np.einsum("tnh,tnc->hc", sf, d), "vb": np.einsum("tnh,tnc->hc", back, d)}
    grads |= backward(w, "f", xt, kf, d @ w["vf"].T)
    grads |= backward(w, "b", xt[::-1], kb, (d @ w["vb"].T)[::-1])
    return loss, grads


class Model:
    """A trained network; ``languages`` are the classes."""

    def __init__(self, languages: list[str], weights: dict[str, np.ndarray]):
        self.languages, self.weights = languages, weights
        hidden = len(weights["mf"])
        # The gates are half the argument of a tanh, so one call serves them.
        half = np.repeat([0.5, 0.5, 1.0], hidden)
        self.x = {s: np.ascontiguousarray((weights[f"x{s}"] * half).T, np.float32) for s in "fb"}
        self.u = {s: np.ascontiguousarray((weights[f"u{s}"] * half).T, np.float32) for s in "fb"}
        self.m = {s: weights[f"m{s}"].astype(np.float32)[:, None] for s in "fb"}
        self.v = {s: np.ascontiguousarray(weights[f"v{s}"].T, np.float32) for s in "fb"}
        self.c = weights["c"].astype(np.float32)[:, None]

    def states(self, side: str, x: np.ndarray) -> np.ndarray:
        """(time, hidden, rows) of one direction over x (time, rows)."""
        hidden = len(self.m[side])
        h = np.zeros((hidden, x.shape[1]), np.float32)
        out = np.empty((len(x), *h.shape), np.float32)
        half = np.float32(0.5)
        for t in range(len(x)):
            g = np.take(self.x[side], x[t], 1)
            u = self.u[side] @ h
            gates = g[: 2 * hidden]
            gates += u[: 2 * hidden]
            np.tanh(gates, gates)
            gates *= half
            gates += half
            n = u[2 * hidden :]
            n += self.m[side]
            n *= gates[hidden:]
            n += g[2 * hidden :]
            np.tanh(n, n)
            h = h - n
            h *= gates[:hidden]
            h += n
            out[t] = h
        return out

    def window_sums(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For windows (rows, time): summed probabilities of the letter positions, how many there are, and sums of the best."""
        xt = np.ascontiguousarray(x.T)
        f, b = self.states("f", xt), self.states("b", xt[::-1])[::-1]
        sums, best = np.zeros((len(self.languages), len(x))), np.zeros(len(x))
        mask = _LETTER[xt]
        for t in range(len(xt)):
            p = self.v["f"] @ f[t]
            p += self.v["b"] @ b[t]
            p += self.c
            p -= p.max(0)
            np.exp(p, p)
            # The best language has the exponential 1.
            scale = mask[t] / p.sum(0)
            p *= scale
            sums += p
            best += scale
        return sums.T, mask.sum(0), best

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """(texts, languages): mean probabilities over the letter positions, zeros without any."""
        return self.judged(texts)[0]

    def judged(self, texts: list[str], block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages): mean probabilities over the letter positions, and the mean of the best there; zeros without any."""
        x, count = windows(texts)
        parts = [self.window_sums(x[i : i + block]) for i in range(0, len(x), block)]
        out = np.zeros((len(texts), len(self.languages)))
        letters, best = np.zeros(len(texts)), np.zeros(len(texts))
        if parts:
            owner = np.repeat(np.arange(len(texts)), count)
            np.add.at(out, owner, np.concatenate([p for p, _, _ in parts]))
            np.add.at(letters, owner, np.concatenate([n for _, n, _ in parts]))
            np.add.at(best, owner, np.concatenate([b for _, _, b in parts]))
        letters = np.maximum(letters, 1)
        return out / letters[:, None], best / letters

    def label(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and certainty of each text: ``und`` and 0 for NULL and texts without a letter."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        p, certain = self.judged([t or "" for t in texts])
        known = [has_letter(t) for t in texts]
        best = p.argmax(1)
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known)]
        return names, np.where(known, np.clip(p.max(1), 0, 1), 0.0), np.where(known, np.clip(certain, 0, 1), 0.0)


def fit(sample: list[tuple[str, str]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = 192, seed: int = 5) -> Model:
    """Train on (language, text) pairs; every language is drawn equally often.  No pairs give a model that knows none."""
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return Model([], new_weights(1, hidden, np.random.default_rng(seed)))
    rng = np.random.default_rng(seed)
    by, own = [], {lang: [] for lang in languages}
    for lang, t in sample:
        own[lang].append(t)
    for lang in languages:
        x, _ = windows(own[lang])
        full = x[_LETTER[x].sum(1) >= WINDOW // 4]
        by.append(full if len(full) else x)
    usable = [k for k, x in enumerate(by) if len(x)]
    w = new_weights(len(languages), hidden, rng)
    adam = Adam(w, 0.02)
    for step in range(steps if usable else 0):
        y = rng.choice(usable, batch)
        x = np.stack([by[k][rng.integers(len(by[k]))] for k in y])
        _, grads = loss_and_gradients(w, x, y)
        adam.step(grads, 1.0 if step < steps * 0.6 else 0.2)
    return Model(languages, w)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fit on about ``per_language`` documents of each language, fewer of each if there are hundreds; a sample chosen by key."""
    return fit(labelled_sample(docs, lang, text, key, per_language, 6, 128))


def identify(docs: DataFrame, model: Model, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score", certainty_out: str | None = None) -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1); columns of these names are replaced.

    The score is the share of the one language; ``certainty_out`` names a column for the mean probability of the best
    language at each letter, which is high for a text in several known languages too.

    NULL texts, and those without a letter, get ``und`` and 0.  Rows, repeated or not, stay as they are.
    """
    kept = [c for c in docs.columns if c not in (lang_out, score_out, certainty_out)]

    @F.pandas_udf("struct<lang: string, score: double, certainty: double>")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            names, score, certain = [], [], []
            texts = s.tolist()
            for a, b in blocks(texts):
                n, p, c = model.label(texts[a:b])
                names += n
                score.append(p)
                certain.append(c)
            yield pd.DataFrame({"lang": names, "score": np.concatenate([[], *score]), "certainty": np.concatenate([[], *certain])})
        spare_memory()

    found = free_name(docs, "_found")
    # A filter on the results would else work them out once for itself and once more for what is selected, in workers of its own.
    rows = docs.select(*kept, apply.asNondeterministic()(F.col(text)).alias(found))
    out = [F.col(f"{found}.lang").alias(lang_out), F.col(f"{found}.score").alias(score_out)]
    return rows.select(*kept, *out, *([F.col(f"{found}.certainty").alias(certainty_out)] if certainty_out else []))
