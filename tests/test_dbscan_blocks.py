"""Density clustering of feature vectors by blocks of cells, against all pairs."""

import numpy as np
import pyarrow as pa
import pytest

from hotbeat.operators import dbscan


def all_pairs(f, w, eps, min_samples):
    """(core, {border point: least core point of the clusters beside it}, least core point of each core point's cluster); ids are positions."""
    near = ((f[:, None] - f[None]) ** 2).sum(2) <= eps * eps
    core = near @ w >= min_samples
    label = np.where(core, np.arange(len(f)), len(f))
    while True:
        least = np.where(near & core[None], label[None], len(f)).min(1)
        if (least[core] == label[core]).all():
            return core, np.where(core, label, least)
        label = np.where(core, least, label)


@pytest.mark.parametrize("features,whole", [(["a", "b", "c", "x", "y"], True), (["a", "b", "c", "x", "y"], False), (["a", "b"], False)])
def test_blocks_equal_all_pairs(spark, features, whole):
    rng = np.random.default_rng(len(features) + whole)
    rows = []
    for area in (1, None):
        grid = rng.integers(0, 40, (350, 3)) * [1, 1, 0.4] if whole else rng.random((350, 3)) * [60, 40, 9]
        rows += [(len(rows) + i, area, *map(float, g), float(k == 0), float(k == 1)) for i, (g, k) in enumerate(zip(grid.round(0) if whole else grid, rng.integers(0, 3, 350)))]
    df = spark.createDataFrame(rows + rows[:200] + [(9000, 1, None, 1.0, 1.0, 0.0, 0.0)], "id long, area int, a double, b double, c double, x double, y double")
    grid_cols = [c for c in features if c in "abc"]
    got = dbscan.dbscan_features(df, 3.0, 5, grid_cols, [c for c in features if c in "xy"], by="area", id_col="id").distinct().collect()
    have = {r["id"]: r["cluster"] for r in got}
    assert have.pop(9000) == -1
    at = [2 + "abcxy".index(c) for c in features]
    for area in (1, None):
        own = [r for r in rows if r[1] == area]
        points: dict = {}
        for r in own + [r for r in rows[:200] if r[1] == area]:
            points.setdefault(tuple(r[i] for i in at), []).append(r[0])
        keys = sorted(points, key=lambda k: min(points[k]))
        core, label = all_pairs(np.array(keys), np.array([len(points[k]) for k in keys]), 3.0, 5)
        number = {v: i for i, v in enumerate(sorted({v for v, c in zip(label, core) if c}))}
        assert 1 < len(number) and not core.all()
        for k, v in zip(keys, label):
            assert {have[i] for i in points[k]} == {number.get(v, -1)}


def test_a_block_leaves_one_link_a_box():
    """Dense boxes are all near each other; what a task hands on grows with the boxes, not with their pairs."""
    f = np.array([(a, b, c) for a in range(16) for b in range(16) for c in range(8)], float)
    cell = np.floor(f / (3.0 / np.sqrt(3))).astype(np.int64)
    lists = lambda x: pa.array(x.tolist())
    t = pa.table({"pid": pa.array(np.arange(len(f))), "w": pa.array(np.ones(len(f), np.int64)), "f": lists(f), "cell": lists(cell),
                  "own": pa.array(np.ones(len(f), bool)), "core": pa.array(np.ones(len(f), bool))})
    assert dbscan._core_points(t, 3, 2, 9.0, 10).all()
    one, other, kinds = dbscan._local_links(t, 3, 2, 9.0)
    sizes = {k: len(x) for x, k in zip(one, kinds)}
    boxes = len(np.unique(cell, axis=0))
    assert sizes[dbscan._MEMBER] == len(f) and sizes[dbscan._LINK] == boxes - 1
