"""Hand-made edge inputs (FIXTURES section 4) and golden values of the source workflow."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hotbeat import fixed
from hotbeat.functions import calendar as cal
from hotbeat.functions import codes
from hotbeat.operators import clean, density, joins, profile, series
from hotbeat.plans.prepare import enrich, prepare


def test_bad_dates(spark):
    df = spark.createDataFrame([("junk",), (None,), ("03/01/2020 12:00:00 AM",), ("13/45/2020 01:00:00 PM",)],
                               "t string")
    got = [r[0] for r in df.select(cal.parse_date("t")).collect()]
    assert got == [None, None, dt.date(2020, 3, 1), None]


def test_clock_values(spark):
    df = spark.createDataFrame([(5,), (930,), (2400,), (12345,), (None,), (2359,), (1260,)], "c int")
    got = [r[0] for r in df.select(cal.format_clock("c")).collect()]
    assert got == ["00:05", "09:30", None, None, None, "23:59", None]
    ts = df.select(cal.occurred_at(F.lit(dt.date(2024, 1, 2)), cal.format_clock("c")).alias("ts"))
    hours = [r[0] for r in ts.select(cal.hour_of("ts")).collect()]
    assert hours == [0, 9, None, None, None, 23, None]
    slots = [r[0] for r in ts.select(cal.time_slot(cal.hour_of("ts"))).collect()]
    assert slots == [1, 2, None, None, None, 3, None]


def test_weekday_sunday_is_one(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date")
    r = df.select(cal.weekday("d"), cal.weekday_name("d"), cal.weekday_monday_first("d")).first()
    assert tuple(r) == (1, "Sunday", 6)


def test_bad_points(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, None, -118.0), (3, 34.0, None), (4, 34.0, -118.0)],
                               "id int, lat double, lon double")
    assert [r.id for r in clean.valid_location(df).collect()] == [4]


def test_dupes(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(2, "b"), (3, "c")], "x int, y string")
    r = clean.duplicate_count(df).first()
    assert (r.duplicates, r.distinct_rows) == (2, 3)
    assert clean.dedupe(df).count() == 3


def test_age_bands(spark):
    ages = [None, -1, 0, 1, 4, 5, 12, 13, 17, 18, 25, 26, 39, 40, 65, 66]
    df = spark.createDataFrame([(a,) for a in ages], "a int")
    got = [r[0] for r in df.select(codes.age_group("a")).collect()]
    assert got == ["Unknown", "Infant", "Infant", "Toddler", "Toddler", "Kid", "Kid", "Teenager", "Teenager",
                   "Young Adult", "Young Adult", "Adult", "Adult", "Middle Age", "Middle Age", "Senior"]
    cleaned = [r[0] for r in clean.clean_age(df, "a").collect()]
    assert cleaned[:4] == [None, None, None, 1]


def test_descent_and_category(spark):
    df = spark.createDataFrame([("H",), ("Q",), (None,), ("Z",)], "d string")
    assert [r[0] for r in df.select(codes.descent_label("d")).collect()] == [
        "Hispanic/Latin/Mexican", "Unknown", "Unknown", "Asian Indian"]
    inc = spark.createDataFrame([(350,), (999,), (None,)], "crm_cd int")
    got = [r.crime_category for r in codes.category_of(inc).orderBy(F.col("crm_cd").asc_nulls_last()).collect()]
    assert got == ["PERSONAL THFT", "Unknown", "Unknown"]
    assert len(fixed.category_codes()) == 139


def test_one_point_cluster(spark):
    one = spark.createDataFrame([(1, 34.0, -118.0)], "g int, lat double, lon double")
    r = density.kde_peak(one, "g").first()
    assert (r.peak_lat, r.peak_lon, r.density, r.n) == (34.0, -118.0, None, 1)
    many = spark.createDataFrame([(1, 34.0, -118.0)] * 50, "g int, lat double, lon double")
    r = density.kde_peak(many, "g").first()
    assert (r.peak_lat, r.peak_lon, r.density) == (34.0, -118.0, None)


def test_gap_series(spark):
    df = spark.createDataFrame([(1, dt.date(2020, m, 3)) for m in (1, 2, 2, 5)], "k int, d date")
    got = [(r.period.month, r.n) for r in series.gap_filled_counts(df, "k", "d").orderBy("period").collect()]
    assert got == [(1, 1), (2, 2), (3, 0), (4, 0), (5, 1)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "incident_id long, occ_date date, rptd_date date, time_occ string, "
                                      "area int, crm_cd int, vict_age int, vict_sex string, category string, "
                                      "lat double, lon double, amount double")
    assert enrich(prepare(empty)).count() == 0
    assert profile.counts_by(empty, "area").count() == 0


def test_golden_grid_and_centre(spark):
    hs = spark.createDataFrame([(1, i, a, o) for i, a, o in fixed.area1_hotspots()],
                               "area int, hotspot_id int, lat double, lon double")
    assert joins.scoring_grid(hs).count() == 840
    slot0 = hs.filter(F.col("hotspot_id").isin(3, 9)).agg(F.avg("lat"), F.avg("lon")).first()
    assert slot0[0] == pytest.approx(34.04579141414141, abs=1e-12)
    assert slot0[1] == pytest.approx(-118.26618535353535, abs=1e-12)


def test_streaming_enrich(spark, tmp_path):
    from hotbeat.streaming.incidents import enrich_stream
    from conftest import SF_SMALL
    q = enrich_stream(spark, SF_SMALL, str(tmp_path / "out"), str(tmp_path / "ckpt"), query_name="enriched_stream_test")
    q.processAllAvailable()
    q.stop()
    n = spark.read.parquet(str(tmp_path / "out")).count()
    from hotbeat.sources import fixtures
    assert n == enrich(prepare(fixtures.incidents(spark, SF_SMALL), dedupe_rows=False)).count()


def test_null_labels_are_split_too(spark):
    from hotbeat.operators import split

    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 3) for i in range(1000)], "k long, label int")
    s = split.stratified_split(df, "label", "k")
    assert s.count() == 1000
    got = {(r["label"], r["split"]): r["count"] for r in s.groupBy("label", "split").count().collect()}
    assert got[None, "train"] == 80 and got[None, "test"] == 20
    assert split.stratified_folds(df, "label", "k").where("label is null").groupBy("fold").count().count() == 5


def test_null_groups_and_columns_without_spread(spark):
    from hotbeat.operators import features, outliers

    df = spark.createDataFrame([(1, 2.0, None), (2, 4.0, None), (3, 5.0, 7)], "k int, v double, area int")
    z = {r["k"]: r["v_z"] for r in features.standardise(df, ["v"], by="area").collect()}
    assert z == {1: -1.0, 2: 1.0, 3: 0.0}
    assert outliers.zscore_outliers(df, ["v"], 0.5, by="area").count() == 2
    assert outliers.zscore_outliers(df.withColumn("v", F.lit(1.0)), ["v"], 0.5).count() == 0


def test_short_series_keep_their_keys(spark):
    rows = [("short", dt.date(2024, m, 1), m) for m in (1, 2, 3)] + [("flat", dt.date(2024, m, 1), 5) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "grp string, period date, n long")
    ar = series.ar_diff_forecast(df, "grp", 4).collect()
    assert {(r["grp"], r["h"]) for r in ar} == {(g, h) for g in ("short", "flat") for h in range(1, 5)}
    fc = series.forecast(df, "grp", (1, 1, 1), 3).collect()
    assert sum(r["grp"] == "short" and r["forecast"] is None for r in fc) == 3
    assert len(series.auto_forecast(df, "grp", None, 3).collect()) == 6


def test_tight_cluster_density_equals_plain_estimator(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    pts = [(1, float(34 + rng.normal(0, 1e-4)), float(-118 + rng.normal(0, 1e-4))) for _ in range(200)]
    df = spark.createDataFrame(pts, "area int, lat double, lon double")
    got = density.kde_grid(df, "area", 40, 0.01).collect()
    assert len(got) == 1600
    x = np.array([p[1:] for p in pts])
    h = np.cov(x.T) * len(x) ** (-1 / 3)
    inverse, norm = np.linalg.inv(h), 1 / (2 * np.pi * np.sqrt(np.linalg.det(h)) * len(x))
    for r in got[::37]:
        e = np.array([r["gx"], r["gy"]]) - x
        want = norm * np.exp(-0.5 * np.einsum("ni,ij,nj->n", e, inverse, e)).sum()
        assert r["density"] == pytest.approx(want, rel=1e-6, abs=1e-250)
    peak = density.kde_peak(df, "area", 40, 0.01).first()
    assert peak["density"] == max(r["density"] for r in got)


def test_knn_of_far_points(spark):
    from hotbeat.operators import spatial

    rows = [(1, i, 34.0 + i * 1e-4, -118.0, 1) for i in range(10)] + [(1, 99, 35.0, -117.0, 1), (2, 5, 1.0, 1.0, 2)]
    df = spark.createDataFrame(rows, "g int, pid long, lat double, lon double, w long")
    got = {(r["g"], r["pid"]): r["kdist"] for r in spatial.knn_distance(df, 3, 0.0005, "g").collect()}
    assert got[2, 5] is None
    assert got[1, 0] == pytest.approx(2e-4) and got[1, 5] == pytest.approx(1e-4)
    assert got[1, 99] == pytest.approx(((35 - 34.0008) ** 2 + 1) ** 0.5)


def test_rejected_lines_name_their_columns(spark, tmp_path):
    from pyspark.sql import types as T

    from hotbeat.sources import io

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("x y", T.DoubleType()), T.StructField("d", T.DateType()), T.StructField("t", T.StringType())])
    (tmp_path / "a.csv").write_text("id,x y,d,t\n1,1.5,2024-01-02,a\n2,,,\nthree,1.5,2024-01-02,b\n4,n/a,not a day,c\n5,1.5\n6,1.5,2024-01-02,d,e\n\"7\",2.5,2024-01-03,\"x, y\"\n")
    good, bad = io.scan_with_rejects(spark, str(tmp_path), schema)
    assert sorted(r["id"] for r in good.collect()) == [1, 2, 7] and good.columns == ["id", "x y", "d", "t"]
    rows = {r["line"]: r["bad_columns"] for r in bad.collect()}
    assert rows == {"three,1.5,2024-01-02,b": "id", "4,n/a,not a day,c": "x y,d", "5,1.5": "", "6,1.5,2024-01-02,d,e": ""}
    assert all(r["file"].endswith("a.csv") for r in bad.collect())
    assert {r["outcome"]: r["n"] for r in io.reject_counts(good, bad).collect()} == {"ok": 3, "id": 1, "x y,d": 1, "shape": 2}


def test_density_clusters_of_a_null_group(spark):
    from hotbeat.operators import dbscan

    rows = [(i, None, 1.0 + i * 0.01, 1.0) for i in range(5)] + [(10 + i, 1, 1.0 + i * 0.01, 1.0) for i in range(5)] + [(20, None, 9.0, 9.0), (21, 1, None, 1.0)]
    d = spark.createDataFrame(rows, "incident_id long, area int, lat double, lon double")
    got = {r.incident_id: r.cluster for r in dbscan.dbscan(d, 0.05, 3, by="area").collect()}
    assert got == {**{i: 0 for i in range(5)}, **{10 + i: 0 for i in range(5)}, 20: -1, 21: -1}


def test_cells_beside_a_crowd_count_as_a_whole_or_by_points(spark):
    """Points around a dense crowd: within reach of all of it, of a part of it, of nothing."""
    import random

    from hotbeat.operators import dbscan
    rng = random.Random(3)
    pts = [(rng.random() * 0.3, rng.random() * 0.3) for _ in range(300)] + [(0.9 + rng.random() * 0.6, rng.random()) for _ in range(60)]
    d = spark.createDataFrame([(i, 1, x, y) for i, (x, y) in enumerate(pts)], "incident_id long, area int, lat double, lon double")
    eps, least = 0.8, 40
    near = [[j for j, q in enumerate(pts) if (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= eps * eps] for p in pts]
    core = {i for i, n in enumerate(near) if len(n) >= least}
    got = {r.incident_id: r.cluster for r in dbscan.dbscan(d, eps, least, by="area").collect()}
    assert {i for i, c in got.items() if c == -1} == {i for i in range(len(pts)) if i not in core and not core & set(near[i])}


def test_feature_cells_equal_brute_force(spark):
    """Five features (two of them beyond the grid), copies, a null group, null features, borders and noise."""
    import random

    from hotbeat.operators import dbscan
    rng = random.Random(11)
    rows = []
    for area in (1, None):
        rows += [(area, rng.gauss(0, 1.2), rng.gauss(0, 1.2), rng.choice((0.0, 3.0)), float(rng.random() < 0.4), float(rng.randrange(3))) for _ in range(170)]
        rows += [(area, rng.uniform(-9, 9), rng.uniform(-9, 9), 1.5, 0.0, 1.0) for _ in range(50)] + [(area, 20.0, -0.0, 0.0, 0.0, 0.0)] * 12
        rows += [(area, 20.0, 2.0, 0.0, 0.0, 0.0), (area, None, 0.0, 0.0, 0.0, 0.0)]
    d = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)],
                              "incident_id long, area int, a double, b double, c double, d double, e double, pid string")
    eps, least = 2.0, 9
    got = {r.incident_id: r.cluster for r in dbscan.dbscan_features(d, eps, least, ["a", "b", "c", "d"], ["e"], by="area").collect()}
    assert set(got) == set(range(len(rows)))
    for area in (1, None):
        ids = [i for i, r in enumerate(rows) if r[0] == area and None not in r[1:]]
        near = {i: [j for j in ids if sum((u - v) ** 2 for u, v in zip(rows[i][1:], rows[j][1:])) <= eps * eps] for i in ids}
        core = {i for i in ids if len(near[i]) >= least}
        label = {}
        for i in sorted(core):
            todo = [] if i in label else [i]
            while todo:
                u = todo.pop()
                if u not in label:
                    label[u] = i
                    todo += [v for v in near[u] if v in core]
        border = {i: min(label[j] for j in near[i] if j in core) for i in ids if i not in core and core & set(near[i])}
        number = {v: n for n, v in enumerate(sorted(set(label.values())))}
        want = {i: number[{**label, **border}[i]] if i in label or i in border else -1 for i in ids}
        assert {i: got[i] for i in ids} == want and border and len(number) > 1 and -1 in want.values()
    assert all(got[i] == -1 for i, r in enumerate(rows) if None in r[1:])
    assert dbscan.dbscan_features(d.limit(0), eps, least, ["a", "b", "c"], by="area").count() == 0
    line = d.where("area = 1").select("incident_id", "a")
    assert dbscan.dbscan_features(line, 0.5, 3, ["a"]).where("cluster >= 0").count() > 0
