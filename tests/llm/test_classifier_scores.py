"""op2 and op5 over whole tables against scores worked out document by document.

The fitted parameters are the operators'; everything from a text to its score is written out here again,
with plain loops and none of the operators' helpers.
"""

import math
import zlib

import pytest
import zstandard

from conftest import SF_SMALL
from hotbeat.llm import quality, queries, toxicity


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in docs}


def compare(rows, texts, plain, cut):
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.score == pytest.approx(plain(texts[r.doc_id]), abs=1e-9)
        assert r.predicted == (1 if r.score >= cut else 0)


def sigmoid(v):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, v))))


def test_toxicity_scores(spark, texts):
    documents, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(documents, labels)
    assert model.constant is None

    def coded(dictionary):
        data = zstandard.ZstdCompressionDict(dictionary or b"\n", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(level=9, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)
    ordinary, toxic = coded(model.ordinary), coded(model.toxic)
    seen = {}

    def saved(window):
        if window not in seen:
            seen[window] = len(ordinary.compress(window)) - len(toxic.compress(window))
        return seen[window]

    def plain(text):
        words = text.lower().encode("utf-8", "replace").split()
        gains = []
        while words:
            gains.append(saved(b" " + b" ".join(words[:8]) + b" "))
            words = words[8:]
        best = sorted(gains, reverse=True)[:6]
        over = [g for g in gains if g > model.threshold]
        n = len(gains)
        x = best + [0.0] * (6 - len(best)) + [len(over) / n if n else 0.0, math.log(1 + len(over)), sum(gains) / n if n else 0.0, math.log(1 + n)]
        mean, scale, weights = model.calibration
        return sigmoid(weights[-1] + sum(w * (v - m) / s for w, v, m, s in zip(weights, x, mean, scale)))

    (name,) = [k for k in queries.QUERIES if k.startswith("op2_")]
    compare(queries.QUERIES[name](spark, SF_SMALL).collect(), texts, plain, 0.5)


def make_up(words):
    """Features of one passage, counted character by character."""
    if not words:
        return [0.0] * 19
    joined = b" ".join(words)
    kinds = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:'\"()-", b"!?",
             b"#$%&*@^~+=<>\\/_{}[]`", b"|", b" "]
    counts = [sum(c in k for c in joined) for k in kinds]
    wide = sum(c >= 128 for c in joined)
    counts += [wide, len(joined) - sum(counts) - wide]
    n = len(words)
    repeats = sum(words[i] == words[i - 1] for i in range(1, n))
    return [c / len(joined) for c in counts] + [
        sum(len(w) for w in words) / n / 10, max(len(w) for w in words) / 50, sum(len(w) == 1 for w in words) / n, len(set(words)) / n,
        repeats / n, sum(w.endswith(b".") for w in words) / n, sum(65 <= w[0] <= 90 for w in words) / n,
        sum(all(65 <= c <= 90 for c in w) for w in words) / n, n / 64]


def test_quality_scores(spark, texts):
    documents, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(documents, labels)
    assert model.constant is None
    w = {k: v.tolist() for k, v in model.weights.items()}

    def times(x, matrix):
        return [sum(a * row[j] for a, row in zip(x, matrix)) for j in range(len(matrix[0]))]

    def plain(text):
        words = text.encode("utf-8", "replace").split()
        passages = [words[i:i + 64] for i in range(0, len(words), 64)] or [[]]
        hidden, attention = [], []
        for p in passages:
            x = [max(-8.0, min(8.0, (v - m) / s)) for v, m, s in zip(make_up(p), model.mean, model.scale)]
            h = [math.tanh(a + b) for a, b in zip(times(x, w["W"]), w["b"])]
            gate = [math.tanh(t) / (1 + math.exp(-u)) for t, u in zip(times(h, w["V"]), times(h, w["U"]))]
            hidden.append(h)
            attention.append(sum(a * b for a, b in zip(gate, w["w"])))
        top = max(attention)
        share = [math.exp(a - top) for a in attention]
        whole = [sum(s * h[j] for s, h in zip(share, hidden)) / sum(share) for j in range(len(hidden[0]))]
        return sigmoid(sum(a * b for a, b in zip(whole, w["c"])) + w["d"][0] + model.shift)

    (name,) = [k for k in queries.QUERIES if k.startswith("op5_")]
    compare(queries.QUERIES[name](spark, SF_SMALL).collect(), texts, plain, 0.3)
