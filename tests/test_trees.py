"""Histogram trees against hand computation, plain enumeration and their own rules."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hotbeat.operators import trees

SCHEMA = "id long, lat double, month int, label double, fold int, x string, w string, model int, node string"
LEVELS = {"month": range(1, 5)}


def signal(n=900, seed=1):
    """Rows whose class follows from lat and month, with some noise."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lat, month = rng.random() * 10, rng.randint(1, 4)
        y = 0 if lat < 4 else 1 if month == 3 else 2
        rows.append((i, lat, month, float(y if rng.random() < 0.9 else rng.randint(0, 2)), i % 5, "x", "w", 1, "n"))
    return rows


@pytest.fixture(scope="module")
def data(spark):
    df = spark.createDataFrame(signal(), SCHEMA)
    columns = trees.fit_columns(df, ["lat"], LEVELS)
    return df, columns, trees.written_cells(df, columns, "label", 3, "fold")


def test_cells_hold_every_row_once(spark, data):
    df, columns, c = data
    got = {(tuple(r["x"]), r["fold"]): r["w"] for r in c.collect()}
    want: dict = {}
    for _, lat, month, y, fold, *_ in signal():
        key = ((sum(cut < lat for cut in columns.cuts[0]), month - 1), fold)
        want.setdefault(key, [0, 0, 0])[int(y)] += 1
    assert got == want and len(columns.cuts[0]) == trees.BINS - 1


def test_rows_without_bin_or_label_take_no_part(spark):
    rows = [(1, 1.0, 1, 0.0, 0), (2, None, 1, 0.0, 0), (3, float("nan"), 1, 1.0, 0), (4, 1.0, None, 1.0, 0), (5, 1.0, 9, 1.0, 0),
            (6, 2.0, 2, None, 0), (7, 2.0, 2, 5.0, 0), (8, 2.0, 2, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, lat double, month int, label double, fold int")
    columns = trees.fit_columns(df, ["lat"], LEVELS)
    got = trees.cells(df, columns, "label", 3, "fold").collect()
    assert sorted((sum(r["w"]), r["fold"]) for r in got) == [(1, -1), (1, 0)]
    nodes = trees.fit_nodes(trees.written_cells(df, columns, "label", 3), columns, [("newton_boosting", {"trees": 2, "rate": 0.1, "depth": 2})])
    p = {r["id"]: r["prediction"] for r in trees.predict(df, nodes, columns, 0).collect()}
    assert {k for k, v in p.items() if v is None} == {2, 3, 4, 5}


def test_empty_table_single_class_and_single_fold(spark):
    empty = spark.createDataFrame([], SCHEMA)
    columns = trees.fit_columns(empty, ["lat"], LEVELS)
    assert trees.search(trees.written_cells(empty, columns, "label", 3, "fold"), columns, ["newton_boosting"]).count() == 0
    one = spark.createDataFrame([(i, float(i % 3), 1, 1.0, 0, "x", "w", 1, "n") for i in range(20)], SCHEMA)
    columns = trees.fit_columns(one, ["lat"], LEVELS)
    c = trees.written_cells(one, columns, "label", 3, "fold")
    for family, n in (("random_forest", 48), ("gradient_boosting", 36), ("newton_boosting", 18)):
        assert trees.search(c, columns, [family]).count() == n
        nodes = trees.fit_nodes(c, columns, [(family, {"trees": 3, "rate": 0.1, "depth": 3, "min_split": 2, "min_leaf": 1, "balanced": True, "min_fraction": 0.0})])
        assert {r[0] for r in trees.predict(one, nodes, columns, 0).select("prediction").collect()} == {1.0}
    none = trees.predict(one, nodes.where("1 = 0"), columns, 0)
    assert none.count() == 20 and none.where("prediction IS NOT NULL").count() == 0


def test_newton_tree_of_two_splits_by_hand(spark):
    """Two classes, eight rows, lat 0..3: -G / (H + 1) with p = 1/2, h = 2 p (1 - p) = 1/2 a row, no shrinkage."""
    rows = [(i, float(i // 4), 1, y, 0, "x", "w", 1, "n") for i, y in enumerate([0.0] * 4 + [1.0, 1.0, 1.0, 0.0] + [0.0] * 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    columns = trees.fit_columns(df, ["lat"], {})
    c = trees.written_cells(df, columns, "label", 2)
    t = [r.asDict() for r in trees.fit_nodes(c, columns, [("newton_boosting", {"trees": 1, "rate": 1.0, "depth": 2})]).where("tree = 0 AND class = 1").collect()]
    by = {r["node"]: r for r in t}
    # class 1: residuals -1/2 a row of lat 0 and 2, sums (-2, +1, -2), hessians (2, 2, 2); both cuts have equal gain, the first wins
    root = 4 / 3 + 1 / 5 - 9 / 7
    assert by[1]["gain"] == pytest.approx(root) and by[2]["value"] == pytest.approx([-2 / 3])
    assert by[3]["gain"] == pytest.approx(1 / 3 + 4 / 3 - 1 / 5) and by[6]["value"] == pytest.approx([1 / 3]) and by[7]["value"] == pytest.approx([-2 / 3])
    assert by[1]["n_rows"] == 12 and by[3]["n_rows"] == 8


def test_minimum_hessian_forbids_small_children(spark):
    rows = [(i, float(i), 1, float(i == 0), 0, "x", "w", 1, "n") for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    columns = trees.fit_columns(df, ["lat"], {})
    c = trees.written_cells(df, columns, "label", 2)
    nodes = trees.fit_nodes(c, columns, [("newton_boosting", {"trees": 1, "rate": 1.0, "depth": 3})])
    assert min(r["n_rows"] for r in nodes.where("tree = 0").collect()) >= 2  # half a unit a row, one unit at least


def gini_gain(rows, weights):
    """Best split of plain rows (bins, class) by weighted gini, by enumeration over rows."""
    def score(part):
        tot = np.zeros(3)
        for i in part:
            tot[rows[i][1]] += weights[rows[i][1]]
        return (tot**2).sum() / tot.sum() if tot.sum() else 0.0
    every, best = range(len(rows)), 0.0
    for f, ordered in ((0, True), (1, False)):
        for b in {r[0][f] for r in rows}:
            right = [i for i in every if (rows[i][0][f] > b if ordered else rows[i][0][f] == b and b > 0)]
            left = [i for i in every if i not in set(right)]
            if left and right:
                best = max(best, score(left) + score(right) - score(every))
    return best


@pytest.mark.parametrize("balanced", [True, False])
def test_first_gini_split_is_the_best_of_all(balanced):
    rng = np.random.default_rng(5)
    rows = [((int(rng.integers(0, 6)), int(rng.integers(0, 4))), int(rng.integers(0, 3))) for _ in range(60)]
    x = np.array([r[0] for r in rows])
    y = np.eye(3)[[r[1] for r in rows]]
    w = len(rows) / (3 * y.sum(0)) if balanced else np.ones(3)
    g = (y * w)[None]
    stats = [*np.moveaxis(g, 2, 0), g.sum(2), np.ones((1, len(rows)))]
    levels, _ = trees.grow_levels(x, np.array([6, 4]), [True, False], stats, 3, trees.Growth(1), rng)
    assert levels[0]["gain"][0] == pytest.approx(gini_gain(rows, w))


def test_first_order_leaves_follow_the_formula(spark, data):
    df, columns, c = data
    t = trees.fit_nodes(c, columns, [("gradient_boosting", {"trees": 1, "rate": 0.1, "depth": 1, "min_fraction": 0.0})])
    root = {r["class"]: r for r in trees.with_names(t, columns).where("tree = 0 AND node = 1").collect()}
    leaf = {(r["class"], r["node"]): r for r in t.where("tree = 0").collect()}
    rows = signal()
    prior = [sum(r[3] == k for r in rows) / len(rows) for k in range(3)]
    for k in range(3):
        s = root[k]
        goes = lambda r: r[1] > s["threshold"] if s["feature"] == "lat" else f"month_{r[2]}" == s["feature"]  # noqa: E731, B023
        for node, side in ((2, False), (3, True)):
            part = [r for r in rows if goes(r) == side]
            res = [(r[3] == k) - prior[k] for r in part]
            assert leaf[k, node]["value"][0] == pytest.approx(0.1 * 2 / 3 * sum(res) / sum(abs(v) * (1 - abs(v)) for v in res))
            assert leaf[k, node]["n_rows"] == len(part)


def test_smallest_leaf_fraction_and_forest_rules_hold(spark, data):
    _, columns, c = data
    chosen = [("gradient_boosting", {"trees": 5, "rate": 0.1, "depth": 5, "min_fraction": 0.1}),
              ("random_forest", {"trees": 12, "depth": 7, "min_split": 40, "min_leaf": 15, "balanced": True})]
    nodes = trees.fit_nodes(c, columns, chosen).cache()
    assert nodes.where("model = 0 AND tree >= 0").agg(F.min("n_rows")).first()[0] >= 90
    forest = nodes.where("model = 1")
    assert forest.agg(F.min("n_rows")).first()[0] >= 15 and forest.where("left >= 0").agg(F.min("n_rows")).first()[0] >= 40
    assert forest.select("tree").distinct().count() == 12 and forest.agg(F.max("node")).first()[0] < 256
    assert {r[0] for r in forest.where("node = 1").select("n_rows").collect()} == {900.0}  # bootstrap of all rows


def test_search_scores_equal_separate_fits(spark, data):
    """A prefix scored on the way (fewer rounds, less depth) equals a model fitted for it alone, read from its nodes."""
    df, columns, c = data
    scores = {(r["family"], r["setting"]): r for r in trees.search(c, columns, ["random_forest", "gradient_boosting", "newton_boosting"]).collect()}
    assert len(scores) == 48 + 36 + 18
    assert [json.loads(scores["newton_boosting", i]["params"]) for i in range(18)] == trees.grid("newton_boosting")
    for family, number in (("random_forest", 0), ("random_forest", 21), ("gradient_boosting", 7), ("newton_boosting", 16)):
        s = trees.grid(family)[number]
        share = []
        for fold in range(5):
            train = c.where(F.col("fold") != fold)
            nodes = trees.fit_nodes(train, columns, [(family, s)])
            p = trees.predict(df.where(F.col("fold") == fold), nodes, columns, 0)
            share.append(p.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0])
        assert np.mean(share) == pytest.approx(scores[family, number]["cv_accuracy"], abs=0.02 if family == "random_forest" else 1e-9)
    best = {r["family"]: r["cv_accuracy"] for r in trees.best_settings(spark.createDataFrame(list(scores.values()))).collect()}
    assert best == {f: max(r["cv_accuracy"] for (g, _), r in scores.items() if g == f) for f in best}
    assert min(best.values()) > 0.85  # the classes follow from the columns; the majority class has about 0.4


def test_leafwise_growth_opens_the_largest_gain(spark, data):
    df, columns, c = data
    nodes = trees.fit_leafwise(c, columns, rounds=20, leaves=6, rate=0.1).cache()
    rows = nodes.where("tree >= 0").collect()
    for key in {(r["tree"], r["class"]) for r in rows}:
        own = [r for r in rows if (r["tree"], r["class"]) == key]
        assert sum(r["left"] < 0 for r in own) <= 6 and all(r["n_rows"] >= 20 for r in own)
        opened = sorted((r for r in own if r["left"] >= 0), key=lambda r: r["left"])
        seen = {0}
        for r in opened:  # children are numbered in the order of opening
            assert r["node"] in seen and all(r["gain"] >= o["gain"] - 1e-9 for o in own if o["node"] in seen and o["left"] > r["left"])
            seen = seen - {r["node"]} | {r["left"], r["right"]}
    p = trees.predict(df, nodes, columns, 0)
    assert p.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > 0.85
    counts = {r["feature"]: r["splits"] for r in trees.split_counts(nodes, columns).collect()}
    assert sum(counts.values()) == sum(r["left"] >= 0 for r in rows) and set(counts) <= {"lat", "month_2", "month_3", "month_4"}


@pytest.fixture(scope="module")
def many(spark):
    """262,144 rows, each a cell of its own; the class follows from the first column."""
    levels = {c: range(64) for c in ("a", "b", "c")}
    df = spark.range(64**3, numPartitions=8).select(*[(F.col("id") / 64**k % 64).cast("int").alias(c) for k, c in enumerate(levels)],
                                                    (F.xxhash64("id") % 5 + 5).cast("int").alias("f"))
    df = df.select("a", "b", "c", F.when(F.col("a") == 7, 1.0).when(F.col("a") == 9, 2.0).otherwise(0.0).alias("label"), (F.col("f") % 5).alias("fold"))
    columns = trees.fit_columns(df, [], levels)
    return df, columns, trees.written_cells(df, columns, "label", 3, "fold")


def test_no_cell_is_left_out_of_a_search(spark, many):
    df, columns, c = many
    assert c.count() == 64**3 and c.agg(F.sum(F.col("w")[1]), F.sum(F.col("w")[2])).first()[:] == (64**2, 64**2)
    rules = {"kind": "gradient", "rounds": [1, 3], "rate": 1.0, "depth": 3, "min_fraction": 0.0, "fold": 2}
    got = trees._fit_keys(c, columns, [rules], keep_nodes=False).collect()
    held = df.where("fold = 2").count()
    assert {(json.loads(r["setting"])["trees"], r["correct"], r["held"]) for r in got} == {(1, held, held), (3, held, held)}


def test_refitted_models_learn_from_every_cell(many):
    """Each family's nodes start from all rows, and the first split has the gain of all rows."""
    df, columns, c = many
    chosen = [("random_forest", {"trees": 2, "depth": 1, "min_split": 2, "min_leaf": 1, "balanced": False}),
              ("gradient_boosting", {"trees": 1, "rate": 0.1, "depth": 1, "min_fraction": 0.0}), ("newton_boosting", {"trees": 1, "rate": 0.1, "depth": 2})]
    nodes = trees.with_names(trees.fit_nodes(c, columns, chosen), columns).collect()
    n = 64**3
    assert {(r["model"], r["n_rows"]) for r in nodes if r["tree"] >= 0 and r["node"] == 1} == {(0, n), (1, n), (2, n)}
    prior = {r["class"]: r["value"][0] for r in nodes if r["model"] == 1 and r["tree"] < 0}
    assert [prior[k] for k in range(3)] == pytest.approx(np.log([62 / 64, 1 / 64, 1 / 64]))
    for model, feature in ((1, "a_7"), (2, "a_7")):  # class 1 against the rest: 4,096 rows of the level, all of the class
        root = next(r for r in nodes if r["model"] == model and r["class"] == 1 and r["tree"] == 0 and r["node"] == 1)
        right = next(r for r in nodes if r["model"] == model and r["class"] == 1 and r["tree"] == 0 and r["node"] == 3)
        assert root["feature"] == feature and right["n_rows"] == 64**2
    g, h, m = 2 / 3, 4 / 9, 64**2  # newton: residuals of the level's rows, second derivative a row
    rest = -(n - m) / 3
    assert root["gain"] == pytest.approx((g * m) ** 2 / (h * m + 1) + rest**2 / (h * (n - m) + 1) - (g * m + rest) ** 2 / (h * n + 1))


def test_cells_of_several_folds_share_their_combination():
    """Trees over cells that share combinations are those over the cells taken one by one."""
    rng = np.random.default_rng(8)
    x = np.array([(a, b) for a in range(7) for b in range(5)])
    at = rng.integers(0, len(x), 300)
    stats = [rng.integers(0, 9, (4, 300)).astype(float) for _ in range(2)]
    stats += [stats[0] + stats[1], np.ones((4, 300))]
    rule = trees.Growth(4, min_rows=3)
    seen = []
    shared, final = trees.grow_shared(x, at, np.array([7, 5]), [True, False], 4, lambda t: [s[t] for s in stats], 2, rule, rng,
                                      lambda level, live, place, nodes: seen.append((live.copy(), place.copy())))
    plain, heap = trees.grow_levels(x[at], np.array([7, 5]), [True, False], stats, 2, rule, rng)
    assert len(shared) == len(plain) > 2 and (final[:, at] == heap).all()
    for a, b, (live, place) in zip(shared, plain, seen):
        assert all((np.asarray(a[k]) == np.asarray(b[k])).all() for k in a)
        for t in range(4):
            key = place[t][at[live[t][at]]]
            rows = np.bincount(key, stats[0][t][live[t][at]], len(a["tree"]))
            assert (rows[a["tree"] == t] == a["total"][0][a["tree"] == t]).all()


def test_registered_search_keeps_the_whole_grids(spark):
    assert [len(trees.grid(f)) for f in ("random_forest", "gradient_boosting", "newton_boosting")] == [48, 36, 18]
    from hotbeat.plans import catalog

    got = catalog.l5_l6_s5_best_model_roundtrip(spark, "/root/testdata/sf0.001")
    rows = got.collect()
    test = catalog.labelled(spark, "/root/testdata/sf0.001").filter("split = 'test'").collect()
    assert sorted(r["incident_id"] for r in rows) == sorted(r["incident_id"] for r in test)
    share = np.mean([r["prediction"] == r["label"] for r in rows if r["label"] is not None])
    assert rows[0]["test_accuracy"] == pytest.approx(share) and json.loads(rows[0]["params"]) in trees.grid(rows[0]["family"])


def test_logistic_models_of_all_keys_reach_their_optimum(spark):
    """The gradient of every key's penalised loss vanishes; a null key, a key of one class and null features included."""
    from hotbeat.operators import classify as clf

    rng = np.random.default_rng(4)
    rows = []
    for area, shift in ((1, 0.0), (2, 3.0), (None, -2.0)):
        for x, y in rng.normal(0, 1, (150, 2)):
            rows.append((len(rows), area, float(10 + x), float(100 * y), float(int(x + shift * y > 0.5) + int(y > 0.8))))
    rows += [(len(rows) + i, 3, float(i), 1.0, 1.0) for i in range(5)]
    extra = [(9001, 1, None, 1.0, 0.0), (9002, 1, 1.0, 1.0, None), (9003, 1, 1.0, 1.0, 7.0), (9004, 4, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows + extra, "id long, area int, u double, v double, label double")
    models = clf.keyed_logistic(df, ["u", "v"], "area")
    got = {r["area"]: r for r in models.collect()}
    assert {*got} == {1, 2, 3, None}
    for area, m in got.items():
        own = [r for r in rows if r[1] == area]
        x = np.array([[r[2], r[3]] for r in own])
        sd = np.where(x.std(0) > 0, x.std(0), 1.0)
        z = np.column_stack([(x - x.mean(0)) / sd, np.ones(len(x))])
        w = np.array(m["w"]).reshape(3, 3)
        s = z @ w.T
        p = np.exp(s - s.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = (p - np.eye(3)[[int(r[4]) for r in own]]).T @ z + np.c_[w[:, :2], np.zeros(3)]
        assert np.abs(g).max() < 1e-3
    out = {r["id"]: r["prediction"] for r in clf.predict_keyed(df, models, ["u", "v"], "area").collect()}
    assert len(out) == len(rows) + 4 and out[9001] is None and out[9004] is None and out[9002] is not None
    assert np.mean([out[r[0]] == r[4] for r in rows]) > 0.8
    assert clf.keyed_logistic(df.limit(0), ["u", "v"], "area").count() == 0
