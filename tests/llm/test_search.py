"""Exact top-k and nearest neighbours against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hotbeat.llm import ann, topk

SCHEMA = "vec_id long, embedding array<double>, id long, v string, row int, s int, u int, d int, score string, rank int"
NAN, INF = float("nan"), float("inf")


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "v", 2, 3, 4, 5, "x", 6) for i, v in vectors], SCHEMA).repartition(3)


def data(seed=1, n=400, dims=24):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(0, 0.2, dims).tolist()) for i in range(n)]
    rows[7] = (7, rows[8][1])  # ties
    rows[40] = (40, rows[8][1])
    rows += [(n, None), (n + 1, [None] + [0.1] * (dims - 1)), (n + 2, [NAN] * dims), (n + 3, [INF] * dims), (n + 4, []),
             (None, [0.5] * dims), (n + 20, [0.0] * dims), (20, rows[21][1]), (600, [1.0, 2.0]), (700, [3.0, 1.0])]
    return rows


def brute(rows, step, k, score, usable):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and usable(v)]
    out = []
    for a, (qi, q) in enumerate(ok):
        if qi % step:
            continue
        found = sorted((-score(q, c), ci) for b, (ci, c) in enumerate(ok) if b != a and len(c) == len(q))[:k]
        out += [(qi, n + 1, ci, -s) for n, (s, ci) in enumerate(found)]
    return sorted(out)


def whole(q, c):
    return sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(q, c))


def product(q, c):
    total = 0.0
    for a, b in zip(q, c):
        total += a * b
    return total


def test_exact_top_k(spark):
    rows = data()
    got = topk.top_k_inner_products(frame(spark, rows), F.col("id") % 100 == 0, 10)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 100, 10, whole, lambda v: True)


def test_exact_top_k_prunes_without_loss():
    rng = np.random.default_rng(3)
    scale = np.exp(-np.arange(96) / 12)  # mass in the first dimensions, so that blocks are cut
    c, q = rng.normal(0, 1, (900, 96)) * scale, rng.normal(0, 1, (5, 96)) * scale
    ids = np.arange(900)
    found = topk.exact_cell((ids, ids, c), (np.arange(2000, 2005), np.arange(5), q), 10)
    want = np.floor(q * 1024) @ np.floor(c * 1024).T
    for n in range(5):
        order = np.lexsort((ids, -want[n]))[:10]
        assert found[2][found[1] == n].tolist() == order.tolist()
        assert found[3][found[1] == n].tolist() == want[n][order].astype(np.int64).tolist()


def test_exact_top_k_of_large_components(spark):
    rows = [(i, [float(2**40 + i), -1e12, 0.001 * i]) for i in range(12)]
    got = topk.top_k_inner_products(frame(spark, rows), F.col("id") == 0, 3).collect()
    assert len(got) == 3
    assert topk._slow_scores(np.array([[2.0**30, 3.0]]), np.array([2.0**29, 1.0])).tolist() == [2**59 + 3]


def test_nearest_equals_exhaustive_search(spark):
    rows = data(2)
    got = ann.nearest(frame(spark, rows), F.col("id") % 20 == 0, 20)
    want = brute(rows, 20, 20, product, lambda v: any(v))
    have = sorted(tuple(r) for r in got.collect())
    assert [r[:3] for r in have] == [r[:3] for r in want]
    assert np.array([r[3] for r in have]) == pytest.approx(np.array([r[3] for r in want]), rel=1e-15, abs=1e-15)


def test_quantisation_bound_holds():
    rng = np.random.default_rng(5)
    v = rng.standard_t(2, (300, 40))
    small, scale, held, err = ann.quantised(v)
    approx = (small * scale[:, None]) @ (small * scale[:, None]).T
    bound = held[:, None] * err[None, :] + err[:, None] * np.sqrt((v**2).sum(1))[None, :]
    assert (np.abs(v @ v.T - approx) <= bound * (1 + 1e-9)).all()


@pytest.mark.parametrize("search", [topk.top_k_inner_products, ann.nearest])
def test_few_or_no_rows(spark, search):
    assert search(frame(spark, []), F.col("id") % 20 == 0, 5).count() == 0
    assert search(frame(spark, [(0, [1.0])]), F.col("id") % 20 == 0, 5).count() == 0
    assert search(frame(spark, [(0, [1.0]), (1, [2.0])]), F.col("id") % 20 == 0, 5).count() == 1


def test_recall_on_the_table(spark):
    """Measured against brute force: the bounds are sound, so recall is 1."""
    rows = [(r[0], [float(x) for x in r[1]]) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0, 20).collect()
    want = {(r[0], r[2]) for r in brute(rows, 20, 20, product, any)}
    assert len(want & {(r["query_id"], r["vec_id"]) for r in got}) / len(want) == 1.0


def test_scan_drops_most_candidates_of_clustered_vectors():
    """On vectors in clusters at least half of the candidates are gone before the last block, and none of the best."""
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((40, 64)) * 1024 * np.linspace(1.5, 0.2, 64)
    c = np.floor(centres[rng.integers(0, 40, 5000)] + rng.standard_normal((5000, 64)) * 100)
    columns = np.ascontiguousarray(c.T)
    mass = topk._block_mass(columns)
    shares = []
    for n in range(0, 5000, 250):
        alive, total, left = topk._scan(columns, mass, c[n], np.flatnonzero(np.arange(5000) != n), 10)
        scores = c @ c[n]
        scores[n] = -np.inf
        assert sorted(total)[-10:] == sorted(scores)[-10:] and (total == scores[alive]).all()
        shares.append(left[-1] / left[0])
    assert max(shares) < 0.5


def test_scan_of_few_candidates_ties_and_zero_vectors():
    c = np.floor(np.random.default_rng(8).standard_normal((12, 20)) * 3)
    c[3] = c[4] = c[5]
    c[6] = 0
    columns = np.ascontiguousarray(c.T)
    for q in (c[0], c[6], c[3]):
        for k in (1, 5, 12, 20):
            alive, total, _ = topk._scan(columns, topk._block_mass(columns), q, None, k)
            assert sorted(total)[-k:] == sorted(c @ q)[-k:]
