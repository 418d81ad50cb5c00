"""Invariant and brute-force checks for the operators without a SQL oracle."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from hotbeat.operators import dbscan, density, graph, kmeans, routes, spatial, split
from hotbeat.operators.classify import class_report
from hotbeat.plans.prepare import prepare
from hotbeat.sources import fixtures


@pytest.fixture(scope="module")
def pts(spark):
    p = prepare(fixtures.incidents(spark, SF_SMALL))
    return p.select("incident_id", "area", "lat", "lon").cache()


def _brute_dbscan(rows, eps, min_samples):
    """Same deterministic rules as the operator, on Python lists (one group)."""
    pts = {}
    for rid, lat, lon in rows:
        k = (lat, lon)
        w, pid = pts.get(k, (0, rid))
        pts[k] = (w + 1, min(pid, rid))
    keys = list(pts)
    nb = {k: [q for q in keys if (k[0] - q[0]) * (k[0] - q[0]) + (k[1] - q[1]) * (k[1] - q[1]) <= eps * eps]
          for k in keys}
    core = {k for k in keys if sum(pts[q][0] for q in nb[k]) >= min_samples}
    label = {k: pts[k][1] for k in core}
    changed = True
    while changed:
        changed = False
        for k in core:
            for q in nb[k]:
                if q in core and label[q] > label[k]:
                    label[q] = label[k]
                    changed = True
    for k in keys:
        if k not in core:
            cands = [label[q] for q in nb[k] if q in core]
            if cands:
                label[k] = min(cands)
    order = sorted(set(label.values()))
    num = {v: i for i, v in enumerate(order)}
    return {k: num[label[k]] if k in label else -1 for k in keys}


def test_dbscan_matches_brute_force(pts):
    eps, m = 0.00055, 5
    got = dbscan.dbscan(pts, eps, m, by="area").select("area", "lat", "lon", "cluster").distinct().collect()
    rows = pts.collect()
    for area in {r.area for r in rows}:
        exp = _brute_dbscan([(r.incident_id, r.lat, r.lon) for r in rows if r.area == area], eps, m)
        mine = {(r.lat, r.lon): r.cluster for r in got if r.area == area}
        assert mine == exp, area


def test_connected_components_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, size=(260, 2))]
    nodes = spark.createDataFrame([(i,) for i in range(300)], "node long")
    e = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.label for r in graph.connected_components(nodes, e).collect()}
    parent = list(range(300))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for i in range(300):
        comp.setdefault(find(i), []).append(i)
    for members in comp.values():
        assert {got[i] for i in members} == {min(members)}


def test_knn_distance_brute_force(pts):
    w = spatial.weighted_points(pts, "area")
    got = {r.pid: r.kdist for r in spatial.knn_distance(w, 5, 0.0005, "area").collect()}
    rows = w.collect()
    for r in rows:
        cands = sorted((math.sqrt((r.lat - q.lat) ** 2 + (r.lon - q.lon) ** 2), q.w) for q in rows if q.area == r.area)
        c, kd = 0, None
        for d, wq in cands:
            c += wq
            if c >= 5:
                kd = d
                break
        if kd is None:
            assert got[r.pid] is None
        else:
            assert got[r.pid] == pytest.approx(kd, abs=1e-12)


def test_exact_rank(spark):
    df = spark.range(0, 5000).withColumn("v", (F.col("id") * 7919) % 1000)
    r = spatial.exact_rank(df, ["v", "id"], partitions=7).collect()
    exp = sorted((row.v, row.id) for row in r)
    got = sorted(r, key=lambda row: row["rank"])
    assert [(x.v, x.id) for x in got] == exp
    assert [x["rank"] for x in got] == list(range(1, 5001))


def test_kmeans_nearest_own_centre(pts):
    centres = kmeans.kmeans(pts, ["lat", "lon"], 4, by="area").collect()
    lab = kmeans.kmeans_labels(pts, ["lat", "lon"], 4, by="area").collect()
    by_area = {}
    for c in centres:
        by_area.setdefault(c.area, []).append(c)
    for r in lab:
        d = {c.cluster: (r.lat - c.lat) ** 2 + (r.lon - c.lon) ** 2 for c in by_area[r.area]}
        assert d[r.cluster] <= min(d.values()) + 1e-18
    assert all(len(v) <= 4 for v in by_area.values())


def test_elbow_k1_closed_form_and_decreasing(pts):
    e = kmeans.elbow(pts, ["lat", "lon"], [1, 2, 4], by="area").collect()
    wc = {(r.area, r.k): r.wcss for r in e}
    for area in {r.area for r in e}:
        assert wc[(area, 4)] <= wc[(area, 1)] + 1e-15


def test_kde_splat_equals_plain(pts):
    got = {r.area: r for r in density.kde_peak(pts, "area", 20, 0.01).collect()}
    rows = pts.collect()
    for area in list(got)[:4]:
        xy = np.array([(r.lat, r.lon) for r in rows if r.area == area])
        n = len(xy)
        cov = np.cov(xy.T, ddof=1) * n ** (-1 / 3)
        inv, det = np.linalg.inv(cov), np.linalg.det(cov)
        gx = np.linspace(xy[:, 0].min() - 0.01, xy[:, 0].max() + 0.01, 20)
        gy = np.linspace(xy[:, 1].min() - 0.01, xy[:, 1].max() + 0.01, 20)
        best = None
        for i, a in enumerate(gx):
            for j, b in enumerate(gy):
                dd = np.array([a, b]) - xy
                q = np.einsum("ni,ij,nj->n", dd, inv, dd)
                v = np.exp(-0.5 * q).sum() / (2 * math.pi * math.sqrt(det) * n)
                if best is None or v > best[0] * (1 + 1e-12):
                    best = (v, a, b)
        assert got[area].peak_lat == pytest.approx(best[1], abs=1e-9)
        assert got[area].peak_lon == pytest.approx(best[2], abs=1e-9)
        assert got[area].density == pytest.approx(best[0], rel=1e-9)


def test_stratified_split_and_folds(spark):
    df = spark.range(0, 3001).withColumn("label", (F.col("id") % 3).cast("int"))
    s = split.stratified_split(df, "label", "id").groupBy("label", "split").count().collect()
    n = {(r.label, r.split): r["count"] for r in s}
    for lab in range(3):
        tot = n[(lab, "train")] + n[(lab, "test")]
        assert n[(lab, "train")] == math.floor(tot * 0.8)
    f = split.stratified_folds(df, "label", "id", 5).groupBy("label", "fold").count().collect()
    for lab in range(3):
        sizes = [r["count"] for r in f if r.label == lab]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    a = split.hash_split(df, "id").select("id", "split").collect()
    b = split.hash_split(df.repartition(5), "id").select("id", "split").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def _km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 6371.0088 * 2 * math.asin(math.sqrt(min(1.0, h)))


def test_routes_are_optimal(spark):
    rng = np.random.default_rng(0)
    spots = {n: [(34 + rng.random() * 0.05, -118.3 + rng.random() * 0.05) for _ in range(n)] for n in (1, 2, 3, 6, 7)}
    rows = [(n, 10 * i, *p) for n, ps in spots.items() for i, p in enumerate(ps)] + [(None, 5, 34.0, -118.0)]
    stops = spark.createDataFrame(rows, "area int, hotspot_id long, lat double, lon double")
    for fixed in (False, True):
        got = {r.area: r for r in routes.plan_routes(stops, "area", fixed_start=fixed).collect()}
        assert got[None].route == [5] and got[None].km == 0
        for n, ps in spots.items():
            length = lambda o: sum(_km(ps[x], ps[y]) for x, y in zip(o, o[1:]))
            orders = [o for o in itertools.permutations(range(n)) if not fixed or o[0] == 0]
            assert sorted(got[n].route) == [10 * i for i in range(n)]
            assert got[n].km == pytest.approx(min(map(length, orders)), abs=1e-5)
            assert length([i // 10 for i in got[n].route]) == pytest.approx(got[n].km, abs=1e-5)


def _nearest_neighbour_km(ps, start):
    route, left = [start], set(range(len(ps))) - {start}
    while left:
        route.append(min(left, key=lambda x: (_km(ps[route[-1]], ps[x]), x)))
        left.discard(route[-1])
    return sum(_km(ps[x], ps[y]) for x, y in zip(route, route[1:]))


def test_evolved_routes_equal_the_exact_ones_of_small_groups(spark):
    rng = np.random.default_rng(2)
    spots = {n: [(34 + rng.random() * 0.05, -118.3 + rng.random() * 0.05) for _ in range(n)] for n in (1, 2, 4, 9, 10)}
    rows = [(n, 10 * i, *p) for n, ps in spots.items() for i, p in enumerate(ps)] + [(None, 5, 34.0, -118.0), (None, 6, 34.0, -118.0), (None, 7, 34.01, -118.0)]
    stops = spark.createDataFrame(rows, "area int, hotspot_id long, lat double, lon double")
    exact = {r.area: r for r in routes.plan_routes(stops, "area").collect()}
    got = {r.area: r for r in routes.genetic_routes(stops, "area").collect()}
    assert {a: r.km for a, r in got.items()} == {a: r.km for a, r in exact.items()}
    assert all(sorted(r.route) == sorted(exact[a].route) for a, r in got.items())
    assert routes.genetic_routes(stops.limit(0), "area").count() == 0


def test_large_groups_are_searched_by_evolution(spark):
    """21 and 25 stops: permutations from the fixed start, no longer than the nearest neighbour, and alike in every run."""
    rng = np.random.default_rng(3)
    spots = {n: [(34 + rng.random() * 0.05, -118.3 + rng.random() * 0.05) for _ in range(n)] for n in (5, 21, 25)}
    stops = spark.createDataFrame([(n, i, *p) for n, ps in spots.items() for i, p in enumerate(ps)], "area int, hotspot_id long, lat double, lon double")
    got = {r.area: r for r in routes.plan_routes(stops, "area", fixed_start=True).collect()}
    for n, ps in spots.items():
        assert sorted(got[n].route) == list(range(n)) and got[n].route[0] == 0
        assert got[n].km == pytest.approx(sum(_km(ps[x], ps[y]) for x, y in zip(got[n].route, got[n].route[1:])), abs=1e-4)
        assert got[n].km <= _nearest_neighbour_km(ps, 0) + 1e-4
    again = {r.area: r for r in routes.plan_routes(stops.repartition(3), "area", fixed_start=True).collect()}
    assert again == got
    few = {r.area: r.km for r in routes.genetic_routes(stops, "area", fixed_start=True, generations=1, epochs=1).collect()}
    assert got[25].km < few[25]  # evolution goes on


def test_line_stops_known_order(spark):
    for n in (0, 1, 2, 3, 8):
        stops = spark.createDataFrame([(1, i, 34.0 + 0.001 * ((i * 5) % max(n, 1)), -118.0) for i in range(n)],
                                      "area int, hotspot_id long, lat double, lon double")
        r = routes.plan_routes(stops, "area").collect()
        if n == 0:
            assert r == []
            continue
        lats = {i: 34.0 + 0.001 * ((i * 5) % max(n, 1)) for i in range(n)}
        seq = [lats[i] for i in r[0].route]
        assert seq == sorted(seq) or seq == sorted(seq, reverse=True)


def test_peak_by_branch_and_bound_is_that_of_the_whole_grid(spark):
    """Blobs, copies, a null group, nodes that tie, a grid that blocks do not divide; most blocks stay closed."""
    rng = np.random.default_rng(8)
    rows = []
    for area, centres in ((1, [(0, 0), (1, 2)]), (None, [(5, 5)]), (2, [(0, 0), (0.3, 0.1), (4, 1)])):
        for c in centres:
            rows += [(area, float(c[0] + dx), float(c[1] + 0.5 * dx + dy)) for dx, dy in rng.normal(0, 0.2, (150, 2))]
        rows += [(area, float(centres[0][0]), float(centres[0][1]))] * 60
    rows += [(3, float(a), float(b)) for a in (0, 1) for b in (0, 1)] * 5 + [(4, 1.0, 1.0)] * 3
    d = spark.createDataFrame(rows, "area int, lat double, lon double")
    for grid in (33, 100):
        got = {r.area: r for r in density.kde_peak(d, "area", grid, 0.01).collect()}
        nodes: dict = {}
        for r in density.kde_grid(d, "area", grid, 0.01).collect():
            nodes.setdefault(r.area, []).append((-round(r.kernel_sum, density.PEAK_DECIMALS), r.i, r.j, r.gx, r.gy, r.density))
        assert {*nodes} == {1, 2, 3, None} and got[4].density is None
        for area, own in nodes.items():
            _, _, _, gx, gy, dens = min(own)
            assert (got[area].peak_lat, got[area].peak_lon) == (gx, gy) and got[area].density == pytest.approx(dens, rel=1e-9)
    known = d.where("area < 3")
    st = density._group_stats(known, ["area"], 100, 0.01, "lat", "lon")
    join = lambda left, stats: left.join(stats, "area")
    pts = join(known.groupBy("area", "lat", "lon").agg(F.count("*").alias("w")), st)
    bounds = density._block_bounds(pts, st, ["area"], 100, "lat", "lon", join).cache()
    best = {r[0]: r[1] for r in bounds.groupBy("area").agg(F.max("lower")).collect()}
    kept = sum(r.upper >= best[r.area] for r in bounds.collect())
    assert kept <= 0.1 * bounds.count()


def test_class_report_support(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 2), (2, 0)], "label int, prediction int")
    r = class_report(df).collect()
    assert sum(x.support for x in r) == 5
    assert r[0].accuracy == pytest.approx(0.6)


def test_kmeans_finds_blobs_of_every_group_and_k(spark):
    """Far blobs, a hot point, a null group, a group with two points, null coordinates."""
    import random
    rng = random.Random(6)
    rows = []
    for area in (1, None):
        for i in range(160):
            rows.append((len(rows), area, i % 4 * 10 + rng.random(), i % 4 % 2 * 10 + rng.random()))
        rows += [(len(rows) + i, area, 3.0, 3.0) for i in range(80)]
    rows += [(len(rows) + i, 2, float(i % 2), 0.0) for i in range(9)]
    n = len(rows)
    rows += [(n, 1, None, 1.0)]
    d = spark.createDataFrame(rows, "incident_id long, area int, x double, y double")
    got = {r.incident_id: r for r in kmeans.kmeans_labels(d, ["x", "y"], 5, by="area").collect()}
    assert len(got) == len(rows) and got[n].cluster is None
    for area in (1, None):
        blob = lambda r: 9 if (r.x, r.y) == (3.0, 3.0) else round((r.x - 0.5) / 10)
        own = {(blob(r), r.cluster) for r in got.values() if r.area == area and r.x is not None}
        assert len(own) == 5 and len({c for _, c in own}) == 5
    assert len({r.cluster for r in got.values() if r.area == 2}) == 2
    centres = kmeans.kmeans(d, ["x", "y"], 5, by="area").collect()
    assert sorted(r["size"] for r in centres if r.area == 2) == [4.0, 5.0] and sum(r["size"] for r in centres) == n
    e = {(r.area, r.k): r.wcss for r in kmeans.elbow(d.where("x IS NOT NULL"), ["x", "y"], [1, 2, 5], by="area").collect()}
    assert len(e) == 9 and e[2, 5] == pytest.approx(0.0) and e[1, 5] == pytest.approx(sum(r.wcss for r in centres if r.area == 1))
    assert kmeans.kmeans(d.limit(0), ["x", "y"], 5).count() == 0
    with pytest.warns(RuntimeWarning):
        kmeans.kmeans(d.where("area = 1"), ["x", "y"], 20, max_iter=1)


def test_frequency_start_equals_the_plain_one(spark):
    import random
    rng = random.Random(3)
    rows = [(a, rng.choice("xxxyz"), rng.choice("mmf")) for a in (1, 2) for _ in range(40)]
    d = spark.createDataFrame(rows, "area int, c string, s string").withColumn("w", F.lit(1.0))
    got = {}
    for r in kmeans.cao_start(d, ["c", "s"], 5, ["area"]).collect():
        got.setdefault(r.area, {})[r.cluster] = (r.c, r.s)
    for area in (1, 2):
        own = [r[1:] for r in rows if r[0] == area]
        dens = {x: sum(sum(o[i] == x[i] for o in own) for i in (0, 1)) / (2 * len(own)) for x in {*own}}
        want = []
        for _ in range(5):
            least = lambda x: min((sum(p != q for p, q in zip(x, y)) for y in want), default=3)
            want.append(min(dens, key=lambda x: (-least(x) * dens[x], x)))
        assert [got[area][j] for j in range(5)] == want


def test_kprototypes_of_null_values_and_hot_rows(spark):
    """Null categories and groups are values; a null number leaves a row without cluster; equal rows share one."""
    rows = [(i, None if i % 2 else 1, float(i % 3) * 100, None if i % 3 == 0 else "ab"[i % 3 - 1]) for i in range(60)]
    rows += [(100, 1, None, "a")] + [(200 + i, 1, 500.0, "z") for i in range(80)]
    d = spark.createDataFrame(rows, "incident_id long, area int, x double, c string")
    got = kmeans.kprototypes(d, ["x"], ["c"], 4, by="area", gamma=1e7).collect()
    assert len(got) == len(rows) and [r.incident_id for r in got if r.cluster is None] == [100]
    groups = {(r.area, r.c, r.cluster) for r in got if r.incident_id != 100}
    assert len(groups) == 7 and len({(a, k) for a, _, k in groups}) == 7
    whole = kmeans.kprototypes(d.where("x IS NOT NULL"), ["x"], ["c"], 4, gamma=1e7)
    assert len({(r.c, r.cluster) for r in whole.collect()}) == 4 and "__g" not in whole.columns
    assert kmeans.kprototypes(d.limit(0), ["x"], ["c"], 2, by="area").count() == 0


def test_kprototypes_end_at_a_fixed_point_and_warn_before_it(spark):
    import random
    rng = random.Random(4)
    rows = [(i, rng.gauss(0, 10), rng.gauss(0, 10), rng.choice("abc")) for i in range(120)]
    d = spark.createDataFrame(rows, "incident_id long, x double, y double, c string")
    got = kmeans.kprototypes(d, ["x", "y"], ["c"], 3, gamma=5.0).collect()
    own = {k: [r for r in got if r.cluster == k] for k in {r.cluster for r in got}}
    proto = {}
    for k, v in own.items():
        count = {c: sum(r.c == c for r in v) for c in "abc"}
        proto[k] = (sum(r.x for r in v) / len(v), sum(r.y for r in v) / len(v), max(count, key=lambda c: (count[c], c)))
    cost = lambda r, p: (r.x - p[0]) ** 2 + (r.y - p[1]) ** 2 + 5.0 * (r.c != p[2])
    assert all(cost(r, proto[r.cluster]) <= min(cost(r, p) for p in proto.values()) + 1e-6 for r in got)
    with pytest.warns(RuntimeWarning):
        kmeans.kprototypes(d, ["x", "y"], ["c"], 3, gamma=5.0, max_iter=1)


def test_kprototypes_label_every_row_and_need_no_luck(spark):
    """Three groups far apart in one number and a category each: every start that keeps three clusters finds them."""
    d = spark.createDataFrame([(i, 1, float(i % 3) * 100 + i % 5, "abc"[i % 3]) for i in range(90)], "incident_id long, area int, x double, c string")
    got = kmeans.kprototypes(d, ["x"], ["c"], 3, by="area", gamma=1000.0).select("incident_id", "c", "cluster").collect()
    assert len(got) == 90 and len({(r.c, r.cluster) for r in got}) == 3 and len({r.cluster for r in got}) == 3


def test_elbow_registers_every_k(spark):
    """k = 1 .. 19 for each area and 1 .. 29 over all; more clusters never cost more than one."""
    from hotbeat.plans import catalog

    rows = catalog.m6_elbow(spark, SF_SMALL).collect()
    by: dict = {}
    for r in rows:
        by.setdefault(r.area, {})[r.k] = r.wcss
    assert sorted(by.pop(None)) == [*range(1, 30)] and all(sorted(v) == [*range(1, 20)] for v in by.values())
    assert all(v[k] <= v[1] * (1 + 1e-9) for v in by.values() for k in v)


def test_hotspot_grid_is_scored_with_clusters(spark, monkeypatch):
    from hotbeat.plans import catalog
    seen = {}
    plain = catalog.patrol.model_scores
    monkeypatch.setattr(catalog.patrol, "model_scores", lambda grid, m: seen.update(grid=grid, m=m) or plain(grid, m))
    load = catalog.io.load_snapshot
    monkeypatch.setattr(catalog.io, "load_snapshot", lambda s, path: seen.setdefault("centres", load(s, path)))
    got = catalog.l11_score_hotspot_grid(spark, SF_SMALL).collect()
    assert seen["m"].stages[0].getInputCols() == [*catalog.DUMMY_FEATURES, "cluster"]
    hs = {(r.area, r.hotspot_id, r.lat, r.lon) for r in catalog.hotspots_top(spark, SF_SMALL).collect()}
    grid = seen["grid"].select("area", "hotspot_id", "lat", "lon", "cluster").distinct().collect()
    assert {tuple(r)[:4] for r in grid} == hs and len(got) == 84 * len(hs) and len(grid) == len(hs)
    centres: dict = {}
    for r in seen["centres"].collect():
        centres.setdefault(r.area, []).append(r)
    near = lambda r: min((((r.lat - c.lat) ** 2 + (r.lon - c.lon) ** 2), c.cluster) for c in centres[r.area])[1]
    assert all(near(r) == r.cluster for r in grid)
