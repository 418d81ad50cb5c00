"""Unit-root test and ARIMA forecasts against plain least squares in numpy, series by series."""

import datetime as dt
import math

import numpy as np
import pytest

from hotbeat.operators import series


def table(spark, named):
    rows = [(k, dt.date(2000, 1, 1) + dt.timedelta(days=i), float(v)) for k, x in named.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "grp string, period date, n double").repartition(5)


def plain_adf(x):
    x = np.asarray(x, float)
    most = min(math.ceil(12 * (len(x) / 100) ** 0.25), len(x) // 2 - 2)
    dx = np.diff(x)

    def fit(lags, first):
        design = np.array([[1.0, x[t]] + [dx[t - i] for i in range(1, lags + 1)] for t in range(first, len(dx))])
        beta, *_ = np.linalg.lstsq(design, dx[first:], rcond=None)
        e = dx[first:] - design @ beta
        return design, beta, float(e @ e)
    aic = []
    for lags in range(most + 1):
        d, _, ssr = fit(lags, most)
        aic.append(len(d) * math.log(ssr / len(d)) + 2 * d.shape[1])
    lags = int(np.argmin(aic))
    d, beta, ssr = fit(lags, lags)
    se = math.sqrt(ssr / (len(d) - d.shape[1]) * np.linalg.inv(d.T @ d)[1, 1])
    return lags, len(d), beta[1], beta[1] / se


def test_augmented_test_equals_plain_least_squares(spark):
    rng = np.random.default_rng(2)
    walk = 900 + np.cumsum(rng.normal(0.5, 1.0, size=150))  # with drift: no way back
    ar = np.zeros(90)
    for t in range(3, 90):
        ar[t] = 0.5 * ar[t - 1] - 0.3 * ar[t - 3] + rng.normal()
    named = {"walk": walk, "ar": 50 + ar, "short": [3, 1, 4, 1, 5, 9, 2, 6.5], None: rng.poisson(20, 60),
             "one": [5], "two": [5, 6], "flat": [7] * 30}
    got = {r.grp: r for r in series.augmented_stationarity(table(spark, named), "grp").collect()}
    assert set(got) == set(named)
    for k in ("walk", "ar", "short", None):
        lags, n, slope, t = plain_adf(named[k])
        r = got[k]
        assert (r.periods, r.lags, r.n) == (len(named[k]), lags, n)
        assert r.slope == pytest.approx(slope, rel=1e-6) and r.t_stat == pytest.approx(t, rel=1e-6)
        assert r.difference == (r.p_value > 0.05)
    assert got["walk"].difference and not got["ar"].difference and got["ar"].lags > 0
    assert all(got[k].t_stat is None and got[k].difference is None for k in ("one", "two", "flat"))
    assert series.augmented_stationarity(table(spark, named).limit(0), "grp").count() == 0


def test_p_values_of_published_critical_values(spark):
    values = [(-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10), (3.0, 1.0), (-20.0, 0.0)]
    d = spark.createDataFrame(values, "t double, p double").withColumn("got", series.unit_root_p(series.F.col("t")))
    assert all(r.got == pytest.approx(r.p, abs=2e-3) for r in d.collect())
    z = spark.createDataFrame([(float(v),) for v in np.linspace(-9, 9, 37)], "z double")
    for r in z.withColumn("p", series.normal_cdf(series.F.col("z"))).collect():
        assert r.p == pytest.approx(0.5 * math.erfc(-r.z / math.sqrt(2)), abs=1e-14)


def plain_arima(x, p, d, q, top, h):
    """The two regressions and the recursion, written out for one series."""
    top_p, top_d, top_q = top
    x = np.asarray(x, float)
    z = np.r_[np.full(d, np.nan), np.diff(x, n=d)] if d else x
    mean = np.nanmean(z)
    z = z - mean
    m = max(min(max(top_p, top_q) + math.ceil(len(x) ** (1 / 3)), len(x) // 4), top_p, 1)
    design = np.array([np.r_[1.0, z[t - m:t][::-1]] for t in range(d + m, len(x))])
    beta, *_ = np.linalg.lstsq(design, z[d + m:], rcond=None)
    e = np.full(len(x), np.nan)
    e[d + m:] = z[d + m:] - design @ beta
    first = top_d + top_q + m
    design = np.array([[1.0] + [z[t - i] for i in range(1, p + 1)] + [e[t - i] for i in range(1, q + 1)] for t in range(first, len(x))])
    beta, *_ = np.linalg.lstsq(design, z[first:], rcond=None)
    r = z[first:] - design @ beta
    sigma2 = float(r @ r) / len(r)
    zs, es, psi = list(z), list(e), []
    for step in range(h):
        zs.append(beta[0] + sum(beta[i] * zs[-i] for i in range(1, p + 1)) + sum(beta[p + i] * es[-i] for i in range(1, q + 1)))
        es.append(0.0)
        psi.append(1.0 if not step else (beta[p + step] if step <= q else 0.0) + sum(beta[i] * psi[step - i] for i in range(1, min(p, step) + 1)))
    path = np.array(zs[len(x):]) + mean
    for level in range(d, 0, -1):
        path, psi = np.diff(x, n=level - 1)[-1] + np.cumsum(path), np.cumsum(psi)
    half = 1.959964 * np.sqrt(sigma2 * np.cumsum(np.square(psi)))
    return len(r) * math.log(sigma2) + 2 * (p + q + 2), sigma2, path, path - half, path + half


def arma(rng, n, phi, theta):
    e, z = rng.normal(size=n + 1), np.zeros(n + 1)
    for t in range(1, n + 1):
        z[t] = phi * z[t - 1] + e[t] + theta * e[t - 1]
    return z[1:]


def test_arima_equals_the_plain_regressions(spark):
    rng = np.random.default_rng(5)
    named = {"a": 50 + np.cumsum(arma(rng, 120, 0.7, 0.3)), None: 9 + arma(rng, 40, 0.2, 0.5), "b": rng.poisson(30, 75)}
    for p, d, q in ((1, 1, 1), (2, 0, 1), (0, 1, 0), (1, 2, 2)):
        got = {}
        for r in series.forecast(table(spark, named), "grp", (p, d, q), 7).collect():
            got.setdefault(r.grp, {})[r.step] = r
        for k, x in named.items():
            aic, sigma2, path, low, high = plain_arima(x, p, d, q, (p, d, q), 7)
            r = [got[k][i] for i in range(1, 8)]
            assert r[0].aic == pytest.approx(aic, rel=1e-6) and r[0].sigma2 == pytest.approx(sigma2, rel=1e-6)
            for name, want in (("forecast", path), ("lower", low), ("upper", high)):
                assert [v[name] for v in r] == pytest.approx(want, rel=1e-6), (k, p, d, q, name)


def test_coefficients_and_order_of_a_known_process(spark):
    rng = np.random.default_rng(1)
    x = arma(rng, 3000, 0.6, 0.4)
    d = table(spark, {"arma": 20 + x, "level": 100 + rng.normal(size=400), "trend": 3.0 * np.arange(200) + np.cumsum(rng.normal(size=200))})
    best = {r.grp: r for r in series.auto_forecast(d, "grp", None, 12).where("step = 12").collect()}
    assert best["arma"].sigma2 == pytest.approx(1.0, abs=0.06) and best["arma"].d == 0 and best["arma"].p + best["arma"].q >= 2
    assert best["arma"].upper - best["arma"].forecast == pytest.approx(1.96 * np.std(x), rel=0.1)
    assert best["level"].forecast == pytest.approx(100, abs=0.5)
    assert best["trend"].forecast == pytest.approx(3.0 * 211 + (d.where("grp = 'trend'").agg({"n": "max"}).first()[0] - 597), abs=8)


def test_best_order_has_the_least_aic_of_the_stable_ones(spark):
    named = {"b": np.random.default_rng(3).poisson(30, 80), "flat": [4] * 40, "few": [1, 2, 4]}
    d = table(spark, named)
    every = series.auto_forecast(d, "grp", None, 2, pick_best=False).where("step = 1").collect()
    assert len(every) == 3 * 18
    best = {r.grp: r for r in series.auto_forecast(d, "grp", None, 2).where("step = 1").collect()}
    assert best["b"].aic in [r.aic for r in every if r.grp == "b"] and best["b"].lower < best["b"].forecast < best["b"].upper
    assert best["flat"].forecast == pytest.approx(4.0) and best["flat"].sigma2 == pytest.approx(0.0)
    assert best["few"].forecast is None and best["few"].aic is None
