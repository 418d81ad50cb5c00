"""Per-key time series: gap-free counts (A23/R1), unit-root tests (R2),
ARIMA forecasts (R3, R4) and the closed-form AR-on-differences (R5).

Counting incidents per (key, period) is an ordinary aggregation.  Windows run
over the resulting series (one row a period of a key; bounded by the time
span, not by incidents) and add the lagged values; every regression is one
aggregate of products by key (``regress``), for all keys and candidate
orders together, and forecasts are column expressions of the coefficients.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hotbeat.operators import regress
from hotbeat.operators.attach import attach
from hotbeat.session import cut_lineage

# FIXED VALUES: 5 % critical value of the Dickey-Fuller t statistic with a
# constant and no trend (large-sample).
DF_CRITICAL_5PCT = -2.86

# FIXED VALUES: MacKinnon's (1994) response surface of the same statistic: where the two polynomials
# meet, the range they cover, and their coefficients from the constant upwards.
TAU_STAR, TAU_MIN, TAU_MAX = -1.61, -18.83, 2.74
TAU_SMALL_P = (2.1659, 1.4412, 0.038269)
TAU_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)

# FIXED VALUE: two-sided 95 % quantile of the normal distribution.
Z95 = 1.959964


def _as_list(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def period_start(ts, freq: str = "month"):
    c = F.col(ts) if isinstance(ts, str) else ts
    if freq == "month":
        return F.trunc(F.to_date(c), "MM")
    if freq == "day":
        return F.to_date(c)
    raise ValueError(freq)


def gap_filled_counts(df: DataFrame, key, ts: str, freq: str = "month",
                      out: str = "n") -> DataFrame:
    """Counts per (key, period) with every period between the key's
    first and last one present (0 when empty).

    The period list per key is built with ``explode(sequence(...))`` from the
    key's min/max - its length is the time span, independent of row counts.
    """
    key = _as_list(key)
    step = "1 month" if freq == "month" else "1 day"
    c = df.groupBy(*key, period_start(ts, freq).alias("period")).agg(F.count(F.lit(1)).alias(out))
    span = c.groupBy(*key).agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    grid = span.select(*key, F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {step}"))).alias("period"))
    return (grid.join(c, key + ["period"], "left")
                .select(*key, "period", F.coalesce(out, F.lit(0)).cast("long").alias(out)))


def ols_exprs(y: str, x: str, dialect: str = "spark") -> dict[str, str]:
    """Aggregate SQL for simple OLS y = a + b x from exact integer sums.

    For integer series (counts and their differences) every sum is exact in
    a 38-digit integer type; slope, intercept and the slope's t statistic
    are then a fixed sequence of IEEE operations on those sums, so any
    engine and any partitioning gives bit-identical results.
    """
    wide = "DECIMAL(38,0)" if dialect == "spark" else "HUGEINT"
    both = f"{y} IS NOT NULL AND {x} IS NOT NULL"

    def sm(e):
        return f"sum(CASE WHEN {both} THEN CAST({e} AS {wide}) END)"
    n = f"count(CASE WHEN {both} THEN 1 END)"
    sx, sy, sxy, sxx, syy = sm(x), sm(y), sm(f"{x} * {y}"), sm(f"{x} * {x}"), sm(f"{y} * {y}")
    num = f"CAST({n} * {sxy} - {sx} * {sy} AS DOUBLE)"
    den = f"CAST({n} * {sxx} - {sx} * {sx} AS DOUBLE)"
    vyy = f"CAST({n} * {syy} - {sy} * {sy} AS DOUBLE)"
    slope = f"CASE WHEN {n} >= 2 AND {den} > 0 THEN {num} / {den} END"
    intercept = f"CASE WHEN {n} >= 2 AND {den} > 0 THEN (CAST({sy} AS DOUBLE) - ({num} / {den}) * CAST({sx} AS DOUBLE)) / {n} END"
    ssr = f"(({vyy}) - ({num}) * ({num}) / ({den})) / {n}"
    t = (f"CASE WHEN {n} > 2 AND {den} > 0 AND {ssr} > 0 THEN ({num} / {den}) / "
         f"sqrt({ssr} / ({n} - 2) / (({den}) / {n})) END")
    return {"n": n, "slope": slope, "intercept": intercept, "t": t}


def stationarity(series: DataFrame, key, period: str = "period", value: str = "n",
                 critical: float = DF_CRITICAL_5PCT) -> DataFrame:
    """R2: Dickey-Fuller regression dx_t = a + b * x_{t-1} per key.

    Returns n, slope b, its t statistic, and ``difference`` = the unit root
    is not rejected (t > critical), i.e. the series should be differenced.
    """
    key = _as_list(key)
    w = Window.partitionBy(*key).orderBy(period)
    s = series.withColumn("__lag", F.lag(value).over(w)).withColumn("__dx", F.col(value) - F.col("__lag"))
    s = s.filter(F.col("__lag").isNotNull())
    o = ols_exprs("__dx", "__lag")
    g = s.groupBy(*key).agg(F.expr(o["n"]).alias("n"), F.expr(o["slope"]).alias("slope"),
                            F.expr(o["t"]).alias("t_stat"))
    return g.withColumn("difference", F.col("t_stat") > critical)


def _lags(column: str, n: int, w) -> Column:
    """The n values before this row, latest first."""
    return F.array(*[F.lag(column, i).over(w) for i in range(1, n + 1)]) if n else F.array().cast("array<double>")


def normal_cdf(z: Column) -> Column:
    """Distribution function of the normal distribution, from the series of its integral from 0."""
    z = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    first = F.struct(z.alias("term"), z.alias("sum"))

    def add(a, k):
        term = a["term"] * z * z / (2 * k + 1)
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))
    whole = F.aggregate(F.sequence(F.lit(1), F.lit(200)), first, add, lambda a: a["sum"])
    return F.lit(0.5) + F.exp(-z * z / 2) / np.sqrt(2 * np.pi) * whole


def unit_root_p(t: Column) -> Column:
    """p-value of a unit-root t statistic (regression with a constant) by the response surface."""
    def polynomial(c):
        return sum((F.lit(v) * F.pow(t, F.lit(float(i))) for i, v in enumerate(c)), F.lit(0.0))
    inside = normal_cdf(F.when(t <= TAU_STAR, polynomial(TAU_SMALL_P)).otherwise(polynomial(TAU_LARGE_P)))
    return F.when(t.isNull(), None).when(t > TAU_MAX, 1.0).when(t < TAU_MIN, 0.0).otherwise(inside)


@F.pandas_udf(T.IntegerType())
def _least_aic_lag(sums: pd.Series, rows: pd.Series) -> pd.Series:
    """Number of lagged differences with the least AIC; the nested fits come from one pass of sweeps."""
    out = []
    for s, n in zip(sums, rows):
        fits = list(regress.sweeps(regress.square(s)))[1:]
        aic = [n * np.log(max(ssr / n, 1e-300)) + 2 * (lag + 2) for lag, (_, ssr, _, _) in enumerate(fits)]
        out.append(int(np.argmin(aic)))
    return pd.Series(out, dtype="Int64")


@F.pandas_udf(T.StructType([T.StructField("slope", T.DoubleType()), T.StructField("t_stat", T.DoubleType())]))
def _level_test(sums: pd.Series, rows: pd.Series) -> pd.DataFrame:
    """Coefficient of the level and its t statistic; null if the fit leaves no freedom or no residual."""
    out = []
    for s, n in zip(sums, rows):
        products = regress.square(s)
        beta, ssr, inverse, used = list(regress.sweeps(products))[-1]
        fits = used == len(beta) and n > used and ssr > 1e-20 * products[-1, -1]
        out.append((beta[1], beta[1] / np.sqrt(ssr / (n - used) * inverse[1, 1])) if fits else (None, None))
    return pd.DataFrame(out, columns=["slope", "t_stat"], dtype="float64")


def augmented_stationarity(series: DataFrame, key, period: str = "period", value: str = "n",
                           significance: float = 0.05) -> DataFrame:
    """R2: augmented Dickey-Fuller test per key, dx_t = a + b x_{t-1} + sum g_i dx_{t-i}.

    Up to ceil(12 (periods / 100)^(1/4)) lagged differences (fewer in short series); their number is the one
    with the least AIC over common observations (ties: fewer), the test is then fitted on all it allows.
    Returns ``periods`` (of the key), ``lags``, ``n`` (observations of the fit), slope b, t_stat, p_value and ``difference`` = p
    above ``significance``.  Keys too short or constant keep their row with a null test.  Rows without period
    or value are left out; a null key is a key.
    """
    key = _as_list(key)
    w, whole = Window.partitionBy(*key).orderBy(period), Window.partitionBy(*key)
    x = F.col(value).cast("double")
    s = series.where(F.col(period).isNotNull() & x.isNotNull()).select(*key, period, x.alias("__x"))
    s = s.withColumns({"periods": F.count(F.lit(1)).over(whole), "__mean": F.avg("__x").over(whole), "__at": F.row_number().over(w)})
    most = F.least(F.ceil(12 * F.pow(F.col("periods") / 100, F.lit(0.25))), F.floor(F.col("periods") / 2) - 2).cast("int")
    s = s.withColumn("__most", most).withColumn("__dx", F.col("__x") - F.lag("__x").over(w))
    longest = s.agg(F.max("__most")).first()[0] or 0
    s = s.withColumn("__level", F.lag(F.col("__x") - F.col("__mean")).over(w)).withColumn("__lags", _lags("__dx", max(longest, 0), w))
    s = cut_lineage(s)

    def fitted(rows: DataFrame, lags: str) -> DataFrame:
        rows = rows.where(F.col("__at") > F.col(lags) + 1)
        vector = F.concat(F.array(F.lit(1.0), "__level"), F.slice("__lags", F.lit(1), F.col(lags)), F.array("__dx"))
        return regress.product_sums(rows.withColumn("__vector", vector), key, "__vector")
    chosen = fitted(s.where("__most >= 0"), "__most").select(*key, _least_aic_lag("sums", "rows").alias("lags"))
    test = fitted(attach(s, chosen, key), "lags").select(*key, F.col("rows").alias("n"), _level_test("sums", "rows").alias("__test"))
    both = attach(test, chosen, key).select(F.struct(*key).alias("__k"), "lags", "n", "__test.*")
    out = s.groupBy(F.struct(*key).alias("__k")).agg(F.max("periods").alias("periods")).join(both, "__k", "left")
    p = unit_root_p(F.col("t_stat"))
    return out.select("__k.*", "periods", "lags", "n", "slope", "t_stat", p.alias("p_value"), (p > significance).alias("difference"))


def ar_diff_forecast(series: DataFrame, key, h: int, period: str = "period", value: str = "n") -> DataFrame:
    """AR(1) on first differences, dx_t = c + phi * dx_{t-1}, h-step forecast.

    Fit per key with ``regr_slope``/``regr_intercept``; forecasts by closed
    form: x_T + sum_{i<=h} (c (1 - phi^i) / (1 - phi) + phi^i dx_T).  A key
    whose series is too short or constant for a fit keeps its rows, with a
    null forecast.
    """
    key = _as_list(key)
    w = Window.partitionBy(*key).orderBy(period)
    s = series.withColumn("__dx", F.col(value) - F.lag(value).over(w))
    s = s.withColumn("__dx1", F.lag("__dx").over(w))
    o = ols_exprs("__dx", "__dx1")
    fit = s.groupBy(*key).agg(
        F.expr(o["slope"]).alias("phi"), F.expr(o["intercept"]).alias("c"),
        F.max_by(F.col(value), F.col(period)).alias("x_last"), F.max_by("__dx", F.col(period)).alias("dx_last"),
        F.max(period).alias("last_period"))
    f = fit.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(h))))
    rest = F.nullif(F.lit(1.0) - F.col("phi"), F.lit(0.0))
    geo = F.col("phi") * (F.lit(1.0) - F.pow("phi", F.col("h").cast("double"))) / rest
    fc = (F.col("x_last") + F.col("c") / rest * (F.col("h") - geo)
          + F.col("dx_last") * geo)
    return f.select(*key, "h", F.add_months("last_period", F.col("h")).alias("period"),
                    "phi", "c", fc.alias("forecast"))


# ---------------------------------------------------------------- ARIMA by two regressions

_LIST = T.ArrayType(T.DoubleType())
_ORDER = T.StructType([T.StructField("c", T.DoubleType()), T.StructField("ar", _LIST), T.StructField("ma", _LIST),
                       T.StructField("sigma2", T.DoubleType()), T.StructField("aic", T.DoubleType()), T.StructField("stable", T.BooleanType())])


@F.pandas_udf(_ORDER)
def _fit_order(sums: pd.Series, rows: pd.Series, most_p: pd.Series, p: pd.Series, q: pd.Series) -> pd.DataFrame:
    """Constant, p lags and q shocks of the products of [1, lags, shocks, target]; AIC from its residuals."""
    out = []
    for s, n, top, ar, ma in zip(sums, rows, most_p, p, q):
        if s is None or n < ar + ma + 3:
            out.append((None, None, None, None, None, None))
            continue
        products = regress.square(s)
        columns = [0, *range(1, 1 + ar), *range(1 + top, 1 + top + ma), len(products) - 1]
        beta, ssr, _, _ = list(regress.sweeps(products[np.ix_(columns, columns)]))[-1]
        phi, theta = beta[1:1 + ar], beta[1 + ar:]
        stable = all((np.abs(np.roots(np.r_[1.0, c])) < 1).all() for c in (-phi, theta))
        out.append((beta[0], phi.tolist(), theta.tolist(), ssr / n, n * np.log(max(ssr / n, 1e-300)) + 2 * (ar + ma + 2), bool(stable)))
    return pd.DataFrame(out, columns=["c", "ar", "ma", "sigma2", "aic", "stable"])


def _recursion(c: Column, ar: Column, ma: Column, values: Column, shocks: Column, h: int) -> Column:
    """The next h values c + ar . values + ma . shocks, both latest first; shocks to come are zero."""
    def dot(a, b):
        return F.aggregate(F.zip_with(a, F.slice(b, F.lit(1), F.size(a)), lambda u, v: u * v), F.lit(0.0), lambda t, u: t + u)

    def step(state, _):
        new = c + dot(ar, state["values"]) + dot(ma, state["shocks"])
        return F.struct(F.concat(F.array(new), state["values"]).alias("values"),
                        F.concat(F.array(F.lit(0.0)), state["shocks"]).alias("shocks"))
    last = F.aggregate(F.sequence(F.lit(1), F.lit(h)), F.struct(values.alias("values"), shocks.alias("shocks")), step)
    return F.reverse(F.slice(last["values"], F.lit(1), F.lit(h)))


def _running(a: Column, start: Column) -> Column:
    """start plus the sums of the first 1, 2, ... entries."""
    return F.transform(F.sequence(F.lit(1), F.size(a)), lambda i: F.aggregate(F.slice(a, F.lit(1), i), start, lambda t, u: t + u))


def forecast(series: DataFrame, key, order=(1, 1, 1), h: int = 12, period: str = "period",
             value: str = "n") -> DataFrame:
    """ARIMA(p, d, q) with a constant per key, h steps with 95 % interval; see ``auto_forecast``."""
    return auto_forecast(series, key, [order], h, period, value, pick_best=False)


def auto_forecast(series: DataFrame, key, orders: Sequence[tuple[int, int, int]] | None = None, h: int = 12,
                  period: str = "period", value: str = "n", pick_best: bool = True) -> DataFrame:
    """Every candidate order per key; the lowest AIC among the stable and invertible ones wins.

    Two regressions (Hannan and Rissanen): a long autoregression of max(p, q) + cuberoot(T) lags estimates
    the shocks, then the differenced value is regressed on its p lags and q lagged shocks.  All orders of a
    key are scored on the same observations, from one aggregate of products.  Forecasts follow the model's
    recursion and are summed d times; the interval adds the squared responses to a shock.  A key too short
    for an order keeps its h rows with null forecasts.  Rows without period or value are left out; a null
    key is a key; of rows with equal period either may come first.
    """
    key = _as_list(key)
    if orders is None:
        orders = [(p, d, q) for d in (0, 1) for p in (0, 1, 2) for q in (0, 1, 2)]
    top_p, top_d, top_q = (max(o[i] for o in orders) for i in range(3))
    w, whole = Window.partitionBy(*key).orderBy(period), Window.partitionBy(*key)
    x = F.col(value).cast("double")
    base = series.where(F.col(period).isNotNull() & x.isNotNull()).select(*key, period, x.alias("__z0"))
    base = base.withColumns({"__T": F.count(F.lit(1)).over(whole), "__at": F.row_number().over(w)})
    long = F.least(F.lit(max(top_p, top_q)) + F.ceil(F.cbrt("__T")), F.floor(F.col("__T") / 4)).cast("int")
    base = base.withColumn("__long", F.greatest(long, F.lit(top_p), F.lit(1)))
    for d in range(1, top_d + 1):
        base = base.withColumn(f"__z{d}", F.col(f"__z{d - 1}") - F.lag(f"__z{d - 1}").over(w))
    longest = base.agg(F.max("__long")).first()[0] or 1
    levels = sorted({d for _, d, _ in orders})
    s = base.withColumn("__s", F.explode(F.array(*[F.struct(F.lit(d).alias("__d"), F.col(f"__z{d}").alias("__z")) for d in levels])))
    s = s.select(*key, period, "__T", "__at", "__long", "__s.*", F.array(*[F.col(f"__z{d}") for d in range(top_d + 1)]).alias("__ends"))
    kd = [*key, "__d"]
    w, whole = Window.partitionBy(*kd).orderBy(period), Window.partitionBy(*kd)
    s = s.withColumn("__mean", F.avg("__z").over(whole)).withColumn("__z", F.col("__z") - F.col("__mean"))
    s = cut_lineage(s.withColumn("__lags", _lags("__z", longest, w)))

    start = F.col("__at") > F.col("__d") + F.col("__long")
    vector = F.concat(F.array(F.lit(1.0)), F.slice("__lags", F.lit(1), F.col("__long")))
    first = regress.product_sums(s.where(start).withColumn("__v", F.concat(vector, F.array("__z"))), kd, "__v")
    s = attach(s, first.select(*kd, regress.least_squares(F.col("sums")).alias("__beta")), kd)
    fit = F.aggregate(F.zip_with(vector, "__beta", lambda a, b: a * b), F.lit(0.0), lambda t, u: t + u)
    s = s.withColumn("__e", F.when(start, F.col("__z") - fit))
    s = cut_lineage(s.withColumn("__shocks", _lags("__e", top_q, w)))

    common = F.col("__at") > top_d + top_q + F.col("__long")
    vector = F.concat(F.array(F.lit(1.0)), F.slice("__lags", F.lit(1), F.lit(top_p)), "__shocks", F.array("__z"))
    sums = regress.product_sums(s.where(common).withColumn("__v", vector), kd, "__v")
    sums = sums.select(F.struct(*kd).alias("__k"), "rows", "sums")

    def newest(column, before, n):  # this row's value and the n - 1 before it
        return F.slice(F.concat(F.array(column), before), F.lit(1), F.lit(max(n, 1)))
    ends = s.groupBy(F.struct(*kd).alias("__k")).agg(F.max_by(F.struct(
        newest("__z", "__lags", top_p).alias("values"), newest("__e", "__shocks", top_q).alias("shocks"), "__ends", "__mean"), "__at").alias("__last"))
    # keys without a fit of the first regression are not in s any more
    known = base.select(F.struct(*key).alias("__key")).distinct()
    cand = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(d).alias("d"), F.lit(q).alias("q")) for p, d, q in orders])
    grid = known.withColumn("__o", F.explode(cand)).select("__key.*", "__o.*")
    grid = grid.withColumn("__k", F.struct(*[F.col(k) for k in key], F.col("d").alias("__d"))).drop(*key)
    grid = grid.join(sums, "__k", "left").join(ends, "__k", "left")
    grid = grid.withColumn("__m", _fit_order("sums", F.coalesce("rows", F.lit(0)), F.lit(top_p), "p", "q")).drop("sums", "rows")
    grid = cut_lineage(grid.select("__k", "p", "d", "q", "__last", "__m.*"))
    if pick_best:
        rank = F.struct(~F.coalesce("stable", F.lit(False)), F.coalesce("aic", F.lit(float("inf"))), "p", "d", "q")
        rest = [c for c in grid.columns if c != "__k"]
        grid = (grid.groupBy(F.struct(*[F.col(f"__k.{k}") for k in key]).alias("__k"))
                .agg(F.min_by(F.struct(*rest), rank).alias("__best")).select("__k", "__best.*"))

    last = F.col("__last")
    path = _recursion(F.col("c"), F.col("ar"), F.col("ma"), last["values"], last["shocks"], h)
    path = F.transform(path, lambda v: v + last["__mean"])
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    one = F.concat(F.array(F.lit(1.0)), zeros(max(top_p, top_q)))
    response = F.slice(F.concat(F.array(F.lit(1.0)), _recursion(F.lit(0.0), F.col("ar"), F.col("ma"), one, one, h)), F.lit(1), F.lit(h))
    for level in range(top_d, 0, -1):
        summed = F.col("d") >= level
        path = F.when(summed, _running(path, last["__ends"][level - 1])).otherwise(path)
        response = F.when(summed, _running(response, F.lit(0.0))).otherwise(response)
    spread = F.transform(_running(F.transform(response, lambda r: r * r), F.lit(0.0)), lambda v: F.sqrt(v * F.col("sigma2")))
    out = grid.withColumn("__path", path).withColumn("__spread", spread)
    step = F.explode(F.sequence(F.lit(1), F.lit(h))).alias("step")
    out = out.select(*[F.col(f"__k.{k}").alias(k) for k in key], "p", "d", "q", "aic", "sigma2", "__path", "__spread", step)
    at, half = F.get("__path", F.col("step") - 1), Z95 * F.get("__spread", F.col("step") - 1)
    return out.select(*key, "p", "d", "q", "step", at.alias("forecast"), (at - half).alias("lower"), (at + half).alias("upper"),
                      "aic", "sigma2")
