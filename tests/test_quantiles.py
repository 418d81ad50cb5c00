"""Exact quantiles by selection against numpy, on ranges that need several rounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hotbeat.operators import outliers, profile, quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.fixture
def rounds(monkeypatch):
    """Few bins and short sorted ranges, so that small tables take many rounds."""
    monkeypatch.setattr(quantiles, "BINS", 16)
    monkeypatch.setattr(quantiles, "SORTED", 6)


def test_equal_to_numpy_for_many_groups_and_columns(spark, rounds):
    rng = np.random.default_rng(4)
    rows = [(g, float(v), int(k), None) for g, m in (("a", 400), (None, 77), ("b", 1), ("c", 2))
            for v, k in zip(10.0 ** rng.uniform(-1, 2, m), rng.integers(0, 4, m))]
    rows += [("d", None, None, None), ("a", None, 3, None)]
    df = spark.createDataFrame(rows, "grp string, x double, k int, empty double").repartition(7)
    got = {r.grp: r for r in quantiles.exact_quantiles(df, ["x", "k", "empty"], PROBS, ["grp"]).collect()}
    assert set(got) == {"a", None, "b", "c"}
    for g, r in got.items():
        for i, c in ((1, "x"), (2, "k")):
            values = [row[i] for row in rows if row[0] == g and row[i] is not None]
            assert r[f"q_{c}"] == pytest.approx(np.quantile(values, PROBS), rel=1e-12)
        assert r.q_empty is None


def test_infinities_nan_and_equal_values(spark, rounds):
    odd = [float("-inf")] * 9 + [-1e308, 1e308, 5e-324, 0.0, -0.0] + [float("inf")] * 9 + [float("nan")] * 9
    df = spark.createDataFrame([(v,) for v in odd] , "x double")
    ranks = [i / (len(odd) - 1) for i in range(len(odd))]
    got = quantiles.exact_quantiles(df, ["x"], [0.0, ranks[9], ranks[13], ranks[14], ranks[-1]]).collect()[0].q_x
    assert got[0] == float("-inf") and got[1] == -1e308 and got[2] == 1e308 and got[3] == float("inf") and np.isnan(got[4])
    same = df.select(F.lit(2.5).alias("x"))
    assert quantiles.exact_quantiles(same, ["x"], [0.3]).collect()[0].q_x == [2.5]
    assert quantiles.exact_quantiles(same.limit(0), ["x"], [0.3]).count() == 0


def test_summary_and_outliers_use_no_percentile_buffer(spark, rounds):
    d = spark.createDataFrame([(i % 3, float(i % 50) + (500.0 if i == 7 else 0.0), "keep") for i in range(300)],
                              "grp int, x double, q_x string")
    one = profile.summary_stats(d, "x")
    assert "percentile" not in one._jdf.queryExecution().optimizedPlan().toString()
    values = [r.x for r in d.collect()]
    assert [one.collect()[0][q] for q in ("q25", "q50", "q75")] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]))
    empty = profile.summary_stats(d.limit(0), "x").collect()[0]
    assert empty["count"] == 0 and empty["q50"] is None
    for by in (None, "grp"):
        for method in ("iqr", "qstd"):
            far = outliers.quartile_outliers(d, ["x"], method, by=by)
            assert far.columns == d.columns and [r.x for r in far.collect()] == [507.0]
