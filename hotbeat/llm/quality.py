"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Each passage is encoded by its make-up (kinds of
characters, lengths and repetition of words).  A small network maps a passage to a hidden vector h and
an attention score w.(tanh(Vh) * sigmoid(Uh)); the softmax of these scores over the document's passages
weights their hidden vectors, and the weighted sum gives the probability of label 1.  Only documents
have labels; which passages matter is learnt from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat.llm.common import label_counts, training_sample

#: Bound of the training sample: documents of each label.
PER_CLASS = 2500
PASSAGE = 64
HIDDEN = 16
ATTENTION = 8
EPOCHS = 40
BATCH = 128
RATE = 0.01
DECAY = 1e-4

_KINDS = {"U": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "l": "abcdefghijklmnopqrstuvwxyz", "d": "0123456789", "p": ".,;:'\"()-", "b": "!?",
          "y": "#$%&*@^~+=<>\\/_{}[]`", "i": "|", "s": " "}
_TABLE = bytearray(b"c" * 128 + b"x" * 128)
for _kind, _characters in _KINDS.items():
    for _c in _characters:
        _TABLE[ord(_c)] = ord(_kind)
_TABLE = bytes(_TABLE)
_COUNTED = [bytes([c]) for c in b"Uldpbyisxc"]
FEATURES = len(_COUNTED) + 9


def encode_passage(words: list[bytes]) -> list[float]:
    """Make-up of a passage: shares of kinds of bytes, lengths and repetition of words."""
    n = len(words)
    if not n:
        return [0.0] * FEATURES
    kinds = b" ".join(words).translate(_TABLE)
    size = len(kinds)
    lengths = [*map(len, words)]
    mean = sum(lengths) / n
    distinct = len({*words})
    return [kinds.count(k) / size for k in _COUNTED] + [
        mean / 10, max(lengths) / 50, lengths.count(1) / n, distinct / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, sum(w[-1:] == b"." for w in words) / n,
        sum(w[:1].isupper() for w in words) / n, sum(w.isalpha() and w.isupper() for w in words) / n, n / PASSAGE]


def encode(text: str) -> np.ndarray:
    """Passages by features; a text without words is one passage of zeros."""
    words = text.encode("utf-8", "replace").split()
    return np.array([encode_passage(words[i:i + PASSAGE]) for i in range(0, max(1, len(words)), PASSAGE)])


@dataclass
class QualityModel:
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None
    shift: float = 0.0
    constant: float | None = None


def _forward(w: dict, x: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> dict:
    """Network over the passages ``x`` of several documents, each a run from its start."""
    h = np.tanh(x @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    s = (t * g) @ w["w"]
    e = np.exp(s - np.repeat(np.maximum.reduceat(s, starts), lengths))
    a = e / np.repeat(np.add.reduceat(e, starts), lengths)
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "logit": z @ w["c"] + w["d"][0]}


def _gradients(w: dict, x, starts, lengths, y) -> dict:
    f = _forward(w, x, starts, lengths)
    err = (1 / (1 + np.exp(-f["logit"])) - y) / len(y)
    h, t, g, a = f["h"], f["t"], f["g"], f["a"]
    out = {"c": f["z"].T @ err, "d": np.array([err.sum()])}
    dz = np.repeat(err[:, None] * w["c"][None, :], lengths, axis=0)
    da = (dz * h).sum(1)
    ds = a * (da - np.repeat(np.add.reduceat(a * da, starts), lengths))
    dt, dg = ds[:, None] * w["w"] * g * (1 - t**2), ds[:, None] * w["w"] * t * g * (1 - g)
    out["w"], out["V"], out["U"] = (t * g).T @ ds, h.T @ dt, h.T @ dg
    dh = (a[:, None] * dz + dt @ w["V"].T + dg @ w["U"].T) * (1 - h**2)
    out["W"], out["b"] = x.T @ dh, dh.sum(0)
    return out


def train(bags: list[np.ndarray], y: np.ndarray, seed: int = 7) -> QualityModel:
    """Adam over batches of documents, in an order fixed by the seed."""
    everything = np.concatenate(bags)
    mean, scale = everything.mean(0), everything.std(0)
    scale[scale < 1e-9] = 1.0
    bags = [np.clip((b - mean) / scale, -8, 8) for b in bags]
    rng = np.random.default_rng(seed)
    make = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = {"W": make(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": make(HIDDEN, ATTENTION), "U": make(HIDDEN, ATTENTION),
         "w": make(ATTENTION), "c": make(HIDDEN), "d": np.zeros(1)}
    m, v, step = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            lengths = np.array([len(bags[i]) for i in chosen])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            step += 1
            for k, g in _gradients(w, np.concatenate([bags[i] for i in chosen]), starts, lengths, y[chosen]).items():
                g = g + DECAY * w[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g**2
                w[k] = w[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return QualityModel(mean, scale, w)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> QualityModel:
    """Fit on at most ``per_class`` labelled documents of each label that are not held out."""
    rows = training_sample(docs, labels, label, per_class)
    n = [sum(y == k for _, y in rows) for k in (0, 1)]
    if min(n) < 2:
        return QualityModel(constant=float(n[1] >= n[0]))
    model = train([encode(t) for t, _ in rows], np.array([y for _, y in rows], np.float64))
    counts = label_counts(docs, labels, label)
    model.shift = float(np.log(counts[1] / counts[0]) - np.log(n[1] / n[0]))
    return model


def predict(model: QualityModel, bags: list[np.ndarray]) -> np.ndarray:
    if not bags:
        return np.zeros(0)
    lengths = np.array([len(b) for b in bags])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    x = np.clip((np.concatenate(bags) - model.mean) / model.scale, -8, 8)
    return 1 / (1 + np.exp(-np.clip(_forward(model.weights, x, starts, lengths)["logit"] + model.shift, -30, 30)))


def score(docs: DataFrame, model: QualityModel, text: str = "text", column: str = "quality") -> DataFrame:
    """Adds the score (0 to 1) of every whole text; null counts as empty, which is one passage of zeros."""
    if model.constant is not None:
        return docs.withColumn(column, F.lit(model.constant))

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(predict(model, [encode(t) for t in texts.tolist()]))

    return docs.withColumn(column, scored(F.coalesce(F.col(text), F.lit(""))))
