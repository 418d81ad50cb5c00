"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, its commonest words; one on toxic text,
the words that stand in many different surroundings there and in no ordinary document of the sample,
followed by the ordinary dictionary.  Both shorten ordinary prose alike, so a window of words that the
toxic dictionary shortens more holds toxic wording.  A document's windows give the bytes saved on its
most suspicious windows, the share of windows beyond a threshold and the mean; a logistic calibration,
fitted on documents that no dictionary has seen, turns them into a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat.llm.common import label_counts, training_sample
from hotbeat.llm.logistic import fit_logistic, logistic

#: Bound of the training sample: documents of each label.
PER_CLASS = 2000
#: Words of a window.
WINDOW = 8
ORDINARY_BYTES = 100_000
TOXIC_BYTES = 4096
LEVEL = 9
#: A word enters the toxic dictionary after so many different words, as a share of the toxic documents
#: learnt from, and after ``LEAST`` at least.  Copies of a document repeat the surroundings, too.
SURROUNDINGS = 0.012
LEAST = 4
TOP = 6


@dataclass
class ToxicityModel:
    """Dictionaries, the window threshold and the calibration; ``constant`` replaces them if a label is missing."""

    toxic: bytes = b""
    ordinary: bytes = b""
    threshold: float = 0.0
    calibration: tuple | None = None
    constant: float | None = None


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split()


def windows(text: str) -> list[bytes]:
    words = words_of(text)
    return [b" " + b" ".join(words[i:i + WINDOW]) + b" " for i in range(0, len(words), WINDOW)]


def compressor(dictionary: bytes):
    import zstandard

    data = zstandard.ZstdCompressionDict(dictionary or b"\n", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False).compress


def train_dictionaries(ordinary: list[str], toxic: list[str]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary content, the most telling words last, where they cost least."""
    common = Counter(w for t in ordinary for w in {*words_of(t)})
    around: dict[bytes, set[bytes]] = {}
    for t in toxic:
        words = words_of(t)
        for before, w in zip([b"", *words], words):
            if w not in common:
                around.setdefault(w, set()).add(before)
    least = max(LEAST, int(len(toxic) * SURROUNDINGS))
    telling = sorted((len(s), w) for w, s in around.items() if len(s) >= least)
    joined = lambda words: b"".join(b" " + w + b" " for w in words)
    content = joined(sorted(common, key=lambda w: (common[w], w)))[-ORDINARY_BYTES:]
    return content, joined(w for _, w in telling)[-TOXIC_BYTES:] + content


def excess(ws: list[bytes], ordinary, toxic) -> np.ndarray:
    """Bytes that the toxic dictionary saves on each window beyond the ordinary one."""
    return np.array([len(ordinary(w)) - len(toxic(w)) for w in ws], np.float64)


def features(d: np.ndarray, threshold: float) -> np.ndarray:
    top = np.zeros(TOP)
    if len(d):
        best = np.sort(d)[::-1][:TOP]
        top[:len(best)] = best
    over = d > threshold
    return np.concatenate([top, [over.mean() if len(d) else 0.0, np.log1p(over.sum()), d.mean() if len(d) else 0.0, np.log1p(len(d))]])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> ToxicityModel:
    """Fit on at most ``per_class`` labelled documents of each label that are not held out."""
    rows = training_sample(docs, labels, label, per_class)
    n = [sum(y == k for _, y in rows) for k in (0, 1)]
    if min(n) < 4:
        return ToxicityModel(constant=float(n[1] > n[0]))
    counts = label_counts(docs, labels, label)
    by = {k: [t for t, y in rows if y == k] for k in (0, 1)}
    ordinary, toxic = train_dictionaries(by[0][::2], by[1][::2])
    held = {k: [windows(t) for t in v[1::2]] for k, v in by.items()}
    a, b = compressor(ordinary), compressor(toxic)
    d = {k: [excess(ws, a, b) for ws in held[k]] for k in (0, 1)}
    pooled = np.concatenate([x for x in d[0] if len(x)] or [np.zeros(1)])
    threshold = float(np.quantile(pooled, 0.998))
    x = np.array([features(v, threshold) for k in (0, 1) for v in d[k]])
    y = np.concatenate([np.zeros(len(d[0])), np.ones(len(d[1]))])
    mean, scale, w = fit_logistic(x, y)
    # the sample has as many documents of either label as there are; the corpus has more ordinary ones
    w[-1] += np.log(counts[1] / counts[0]) - np.log(len(d[1]) / len(d[0]))
    return ToxicityModel(toxic, ordinary, threshold, (mean, scale, w))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", column: str = "toxicity") -> DataFrame:
    """Adds the score (0 to 1) of every whole text; null and empty texts have no windows and get a score like any."""
    if model.constant is not None:
        return docs.withColumn(column, F.lit(model.constant))

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a, b = compressor(model.ordinary), compressor(model.toxic)
        for texts in parts:
            x = np.array([features(excess(windows(t), a, b), model.threshold) for t in texts.tolist()]).reshape(len(texts), TOP + 4)
            yield pd.Series(logistic(x, model.calibration))

    return docs.withColumn(column, scored(F.coalesce(F.col(text), F.lit(""))))
