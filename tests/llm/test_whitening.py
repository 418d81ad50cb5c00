"""Whitening and its bidiagonal solver against numpy's dense solvers."""

import math

import numpy as np
import pytest

from hotbeat.llm import whitening
from hotbeat.llm.bidiagonal import bidiagonalise, leading_directions, squared_singular_values

SCHEMA = "vec_id long, embedding array<double>, x string, id string, component int, n string, d string, label int"
EXTRA = ("x", "i", 9, "n", "d", 1)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def matrices():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    same = rng.standard_normal((64, 64))
    same[:, 3], same[:, 5] = 0, same[:, 6]
    return {"one": rng.standard_normal((6, 1)), "two": rng.standard_normal((7, 2)), "random": rng.standard_normal((300, 64)),
            "wide": rng.standard_normal((3, 10)), "one row": rng.standard_normal((1, 6)), "identity": np.eye(8), "orthogonal": q,
            "pairs": np.diag(np.repeat(np.arange(1, 33), 2)) @ q, "zero": np.zeros((5, 5)), "ones": np.ones((50, 20)),
            "close": np.diag(np.r_[1, 1 - 1e-9, 1 - 2e-9, 1 - 1e-12, np.linspace(.9, .1, 60)]) @ q,
            "graded": np.diag(10.0 ** -np.arange(64)) @ q, "graded up": np.diag(10.0 ** np.arange(64) / 1e30) @ q,
            "huge": rng.standard_normal((30, 20)) * 1e100, "tiny": rng.standard_normal((30, 20)) * 1e-100,
            "glued": np.kron(np.eye(3), np.tri(21) + np.eye(21) * 1e-8), "deficient": same,
            "rank two": rng.standard_normal((100, 2)) @ rng.standard_normal((2, 30))}


@pytest.mark.parametrize("name", matrices())
def test_leading_directions_equal_dense_solver(name):
    a = matrices()[name]
    count = min(4, a.shape[1])
    values, z = leading_directions(a, count)
    want = np.pad(np.linalg.svd(a, compute_uv=False), (0, a.shape[1]))[:count]
    top = want[0] or 1.0
    assert np.allclose(np.sqrt(values), want, atol=1e-13 * top, rtol=0)
    live = values > 0
    assert np.allclose(z[live] @ z[live].T, np.eye(live.sum()), atol=1e-12)
    assert np.allclose(a.T @ (a @ z.T) / top**2, z.T * values / top**2, atol=1e-12)


def test_dqds_keeps_relative_accuracy_of_tiny_values():
    # bidiagonal with known product of singular values; values span 40 orders of magnitude
    b, f = 10.0 ** -np.arange(0, 40, 2.0), np.full(19, 1e-3) * 10.0 ** -np.arange(0, 38, 2.0)
    s2 = squared_singular_values(b, f)
    assert math.isclose(np.log(s2).sum() / 2, np.log(b).sum(), rel_tol=1e-13)
    diagonal, above, _ = bidiagonalise(np.diag(b) + np.diag(f, 1))
    assert np.allclose(np.abs(diagonal), b) and np.allclose(np.abs(above), f)


def expected(rows, components=4):
    """Plain whitening by numpy's symmetric eigensolver, for vectors of one length."""
    clean = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows
             if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({x for _, x in clean}), float)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    cov = centred.T @ centred / n
    e, z = np.linalg.eigh(cov)
    e, z = e[::-1][:components], z[:, ::-1][:, :components]
    out = []
    for i, x in clean:
        x = np.array(x, float)
        w = (x - s / n) @ z / np.sqrt(e)
        deviation = sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s))
        out += [(i, k + 1, n, deviation, w[k], e[k] / np.trace(cov)) for k in range(len(e))]
    return out


def compare(got, want):
    got = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in got), key=lambda t: (str(t[0]), t[1], t[3], abs(t[4])))
    want = sorted(want, key=lambda t: (str(t[0]), t[1], t[3], abs(t[4])))
    assert [t[:4] for t in got] == [t[:4] for t in want]
    signs = {}
    for g, w in zip(got, want):
        if abs(w[4]) > 1e-6:
            assert signs.setdefault(g[1], np.sign(g[4] * w[4])) == np.sign(g[4] * w[4])  # one sign a component
        assert abs(abs(g[4]) - abs(w[4])) < 1e-8 and math.isclose(g[5], w[5], rel_tol=1e-9)


def test_whitened_rows_equal_dense_solver(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((200, 12)) * np.linspace(2, 0.1, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(300 + i, base[0].tolist()) for i in range(100)]  # a third of all rows is one vector
    rows += [(5, base[5].tolist()), (None, base[6].tolist()), (400, None), (401, []), (402, [None] * 12), (403, [float("nan")] * 12),
             (404, [float("inf")] + [0.0] * 11), (405, [-0.0, 0.001] + [0.0] * 10)]
    got = whitening.whiten(frame(spark, rows).repartition(40)).collect()
    compare(got, expected(rows))
    assert all(r["identity_error"] < 1e-9 for r in got)


def test_table_is_fitted_whole(spark):
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pydict()
    got = whitening.whiten(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")).collect()
    compare(got, expected(list(zip(t["vec_id"], t["embedding"]))))


def test_degenerate_tables(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [float("nan")])])).count() == 0
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(one) == 4 and all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None and r["identity_error"] is None for r in one)
    line = whitening.whiten(frame(spark, [(1, [0.0, 1.0, 5.0]), (2, [2.0, 1.0, 5.0]), (3, [4.0, 1.0, 5.0])])).collect()
    assert {(r["component"], r["explained"]) for r in line} == {(1, 1.0), (2, 0.0), (3, 0.0)}
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in line)
    mixed = whitening.whiten(frame(spark, [(1, [1.0]), (2, [3.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, [1e300, -1e300, 0.0]), (6, [0.0, 1.0, 2.0])])).collect()
    by_id = {r["vec_id"]: r for r in mixed if r["component"] == 1}
    assert math.isclose(abs(by_id[1]["whitened"]), 1.0) and by_id[1]["n"] == 2 and by_id[1]["deviation"] == 512**2
    assert by_id[5]["deviation"] is None and by_id[5]["n"] == 2


def test_long_vectors_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)  # tasks run in workers of their own; the driver's plan uses FAN_IN
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(300) * np.linspace(3, 1, 300)).tolist()) for i in range(120)]
    compare(whitening.whiten(frame(spark, rows).repartition(9)).collect(), expected(rows))
