"""Gaussian kernel density on a grid per group (M11 peak, M12 whole area, M13 surface).

Same estimator as a Scott-bandwidth Gaussian KDE: per group, H = S * n^(-1/3)
(S = sample covariance of the rows, d = 2), density(g) = (1/n) sum_i w_i
N(g; x_i, H), evaluated on a G x G grid from min - pad to max + pad
(inclusive ends) on each axis.

Every node of a surface takes a contribution of every point, as the estimator
says; a peak is found by branch and bound over blocks of nodes.  A weighted distinct point is spread over the grid in short runs of nodes; the
nodes of a run are sums of one aggregate row, so partial aggregation leaves
one row a run and task, and a hot group spreads over all tasks.  The
arg-max per group is a ``max`` of a struct (map-side partial).
"""

from __future__ import annotations

import math
import operator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat.operators.attach import MAX_GROUPS, attach
from hotbeat.session import cut_lineage

#: Sums that agree to so many decimals are equal when peaks are compared: the
#: order of addition must not decide between mirror-image nodes.
PEAK_DECIMALS = 9
#: Nodes of a run of the surface.
RUN = 10
#: Nodes along a side of a block that the search for a peak opens or leaves out as a whole.
BLOCK = 5


def _as_list(by) -> list[str]:
    if not by:
        return []
    return [by] if isinstance(by, str) else list(by)


def _group_stats(d: DataFrame, by: list[str], grid: int, pad: float, x: str, y: str) -> DataFrame:
    """One row per group with a density: bandwidth, its inverse, norm, and origin and spacing of the grid."""
    st = d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.var_samp(x).alias("sxx"), F.var_samp(y).alias("syy"),
        F.covar_samp(x, y).alias("sxy"), F.min(x).alias("x_lo"), F.max(x).alias("x_hi"),
        F.min(y).alias("y_lo"), F.max(y).alias("y_hi"))
    f2 = F.pow(F.col("n").cast("double"), F.lit(-1.0 / 3.0))
    return (st.withColumn("hxx", F.col("sxx") * f2).withColumn("hyy", F.col("syy") * f2)
            .withColumn("hxy", F.col("sxy") * f2)
            .withColumn("det", F.col("hxx") * F.col("hyy") - F.col("hxy") * F.col("hxy"))
            .filter(F.col("det") > 0)
            .withColumn("ixx", F.col("hyy") / F.col("det")).withColumn("iyy", F.col("hxx") / F.col("det"))
            .withColumn("ixy", -F.col("hxy") / F.col("det"))
            .withColumn("norm", F.lit(1.0) / (F.lit(2 * math.pi) * F.sqrt("det") * F.col("n")))
            .withColumn("x0", F.col("x_lo") - pad).withColumn("y0", F.col("y_lo") - pad)
            .withColumn("dx", (F.col("x_hi") + pad - F.col("x0")) / (grid - 1))
            .withColumn("dy", (F.col("y_hi") + pad - F.col("y0")) / (grid - 1)))


def kde_grid(df: DataFrame, by=None, grid: int = 100, pad: float = 0.01, x: str = "lat", y: str = "lon") -> DataFrame:
    """Density surface rows (by, i, j, gx, gy, density) per group."""
    by = _as_list(by)
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    st = _group_stats(d, by, grid, pad, x, y)
    # One row per group: broadcast (or a scalar subquery without groups).
    pts = d.groupBy(*by, x, y).agg(F.count(F.lit(1)).alias("w"))
    p = attach(pts, st, by)
    p = (p.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
          .withColumn("ex", F.col("x0") + F.col("i") * F.col("dx") - F.col(x))
          .withColumn("jb", F.explode(F.sequence(F.lit(0), F.lit(grid - 1), F.lit(RUN)))))

    def kernel(t: int):
        ey = F.col("y0") + (F.col("jb") + t) * F.col("dy") - F.col(y)
        q = F.col("ixx") * F.col("ex") * F.col("ex") + F.lit(2.0) * F.col("ixy") * F.col("ex") * ey + F.col("iyy") * ey * ey
        return F.sum(F.col("w") * F.exp(F.lit(-0.5) * q)).alias(f"s{t}")

    runs = p.groupBy(*by, "i", "jb").agg(*[kernel(t) for t in range(RUN)],
                                         *[F.first(c).alias(c) for c in ("norm", "x0", "dx", "y0", "dy")])
    nodes = (runs.select(*by, "i", "jb", "norm", "x0", "dx", "y0", "dy",
                         F.posexplode(F.array(*[f"s{t}" for t in range(RUN)])).alias("t", "s"))
                 .withColumn("j", F.col("jb") + F.col("t")).filter(F.col("j") < grid))
    return nodes.select(*by, "i", "j", (F.col("x0") + F.col("i") * F.col("dx")).alias("gx"),
                        (F.col("y0") + F.col("j") * F.col("dy")).alias("gy"),
                        (F.col("s") * F.col("norm")).alias("density"), F.col("s").alias("kernel_sum"))


def _block_bounds(p: DataFrame, st: DataFrame, by: list[str], grid: int, x: str, y: str, beside) -> DataFrame:
    """(by, bi, bj, upper, lower): bounds of the largest kernel sum on the nodes of every block.

    The sum and its first and second derivatives at the block's centre give a quadratic; the third
    derivative along any unit direction at distance r (in bandwidths) is at most
    max(|t^3 - 3t|, t <= r) exp(-r^2 / 2), which every point adds for the nearest it can come to the block.
    """
    blocks = -(-grid // BLOCK)
    half = (BLOCK - 1) / 2
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    u, v = half * F.col("dx"), half * F.col("dy")
    cross = 2 * F.abs(F.col("ixy")) * u * v
    p = p.withColumn("reach", F.sqrt(F.col("ixx") * u * u + cross + F.col("iyy") * v * v))
    p = p.withColumn("bi", F.explode(every)).withColumn("bj", F.explode(every))
    ex = F.col("x0") + (F.col("bi") * BLOCK + half) * F.col("dx") - F.col(x)
    ey = F.col("y0") + (F.col("bj") * BLOCK + half) * F.col("dy") - F.col(y)
    p = p.select(*by, "bi", "bj", "w", "ixx", "ixy", "iyy", "reach",
                 (F.col("ixx") * ex + F.col("ixy") * ey).alias("gx"), (F.col("ixy") * ex + F.col("iyy") * ey).alias("gy"),
                 ex.alias("ex"), ey.alias("ey"))
    p = p.withColumn("q", F.col("gx") * F.col("ex") + F.col("gy") * F.col("ey"))
    p = p.withColumn("k", F.col("w") * F.exp(-0.5 * F.col("q")))
    p = p.withColumn("near", F.greatest(F.lit(0.0), F.sqrt(F.greatest(F.lit(0.0), F.col("q"))) - F.col("reach")))
    far = F.exp(-0.5 * F.col("near") * F.col("near"))
    third = (F.when(F.col("near") < 1, F.lit(1.3803)).when(F.col("near") < 2.3345, F.greatest(2 * far, F.lit(0.3753)))
             .otherwise((F.col("near") * F.col("near") - 3) * F.col("near") * far))
    k, gx, gy = F.col("k"), F.col("gx"), F.col("gy")
    sums = (p.groupBy(*by, "bi", "bj").agg(
        F.sum(k).alias("s"), F.sum(-k * gx).alias("sx"), F.sum(-k * gy).alias("sy"), F.sum(k * (gx * gx - F.col("ixx"))).alias("sxx2"),
        F.sum(k * (gx * gy - F.col("ixy"))).alias("sxy2"), F.sum(k * (gy * gy - F.col("iyy"))).alias("syy2"),
        F.sum(F.col("w") * third).alias("rest")))
    b = beside(sums, st.select(*by, "ixx", "ixy", "iyy", "dx", "dy"))
    offsets = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(BLOCK) for j in range(BLOCK)]
    nodes = F.filter(F.array(*offsets), lambda o: (F.col("bi") * BLOCK + o["i"] < grid) & (F.col("bj") * BLOCK + o["j"] < grid))

    def at(sign):
        def value(o):
            a, c = (o["i"] - half) * F.col("dx"), (o["j"] - half) * F.col("dy")
            size = F.sqrt(F.greatest(F.lit(0.0), F.col("ixx") * a * a + 2 * F.col("ixy") * a * c + F.col("iyy") * c * c))
            quadratic = F.col("s") + F.col("sx") * a + F.col("sy") * c + 0.5 * (F.col("sxx2") * a * a + 2 * F.col("sxy2") * a * c + F.col("syy2") * c * c)
            return quadratic + sign * size * size * size / 6 * F.col("rest")
        return F.array_max(F.transform(nodes, value))
    return b.select(*by, "bi", "bj", at(1).alias("upper"), at(-1).alias("lower"))


def kde_peak(df: DataFrame, by=None, grid: int = 100, pad: float = 0.01, x: str = "lat", y: str = "lon") -> DataFrame:
    """Densest grid node per group -> (by, peak_lat, peak_lon, density, n).

    Branch and bound: blocks of nodes whose upper bound lies below another block's lower bound are left
    out, every node of the others is summed exactly.  The result is that of the whole grid.

    Ties go to the smallest (i, j), i.e. smallest (lat, lon).  Groups whose
    covariance is singular (one point, or all points on a line) have no
    density; their peak is the weighted mean point, flagged ``density`` null.
    """
    b = _as_list(by)
    rows = cut_lineage(df.select(*b, x, y))  # read by four aggregates
    d = rows.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    st = cut_lineage(_group_stats(d, b, grid, pad, x, y))
    few = bool(b) and st.count() <= MAX_GROUPS

    def beside(left: DataFrame, stats: DataFrame) -> DataFrame:
        """Rows with the statistics of their group, which are one row a group."""
        if not b:
            return attach(left, stats, [])
        keyed = stats.withColumnsRenamed({c: f"__key_{c}" for c in b})
        on = reduce(operator.and_, [left[c].eqNullSafe(keyed[f"__key_{c}"]) for c in b])
        return left.join(F.broadcast(keyed) if few else keyed, on).drop(*[f"__key_{c}" for c in b])

    p = cut_lineage(beside(d.groupBy(*b, x, y).agg(F.count(F.lit(1)).alias("w")), st))
    bounds = cut_lineage(_block_bounds(p, st, b, grid, x, y, beside))
    best = bounds.groupBy(*b).agg(F.max("lower").alias("__floor"))
    # sums that agree to PEAK_DECIMALS are equal, so a block stays if it may come that near
    open_ = (beside(bounds, best).where(F.col("upper") >= F.col("__floor") * (1 - 1e-9) - 10.0 ** (1 - PEAK_DECIMALS))
             .groupBy(*b).agg(F.collect_list(F.struct("bi", "bj")).alias("__open")))  # at most all blocks of a grid
    q = beside(p, open_).withColumn("__at", F.explode("__open")).withColumn("__a", F.explode(F.sequence(F.lit(0), F.lit(BLOCK - 1))))
    q = q.select(*b, "w", "ixx", "ixy", "iyy", "y0", "dy", y, (F.col("__at.bi") * BLOCK + F.col("__a")).alias("i"), (F.col("__at.bj") * BLOCK).alias("j"),
                 (F.col("x0") + (F.col("__at.bi") * BLOCK + F.col("__a")) * F.col("dx") - F.col(x)).alias("__ex"))

    def kernel(c: int):
        ex, ey = F.col("__ex"), F.col("y0") + (F.col("j") + c) * F.col("dy") - F.col(y)
        return F.sum(F.col("w") * F.exp(-0.5 * (F.col("ixx") * ex * ex + 2.0 * F.col("ixy") * ex * ey + F.col("iyy") * ey * ey)))

    sums = q.where(F.col("i") < grid).groupBy(*b, "i", "j").agg(*[kernel(c).alias(f"s{c}") for c in range(BLOCK)])
    node = (beside(sums, st.select(*b, "norm", "x0", "dx", "y0", "dy"))
            .select("*", F.posexplode(F.array(*[f"s{c}" for c in range(BLOCK)])).alias("t", "s"))
            .withColumn("j", F.col("j") + F.col("t")).where(F.col("j") < grid))
    peak = F.struct(F.round("s", PEAK_DECIMALS).alias("r"), (-F.col("i")).alias("ni"), (-F.col("j")).alias("nj"),
                    (F.col("x0") + F.col("i") * F.col("dx")).alias("gx"), (F.col("y0") + F.col("j") * F.col("dy")).alias("gy"),
                    (F.col("s") * F.col("norm")).alias("density"))
    best = (node.groupBy(*b).agg(F.max(peak).alias("__b"))
            .select(*b, F.col("__b.gx").alias(f"peak_{x}"), F.col("__b.gy").alias(f"peak_{y}"), F.col("__b.density").alias("density")))
    means = rows.groupBy(*b).agg(F.avg(x).alias("__mx"), F.avg(y).alias("__my"), F.count(F.lit(1)).alias("n"))
    if b:
        keyed = best.withColumnsRenamed({c: f"__key_{c}" for c in b})
        joined = means.join(keyed, reduce(operator.and_, [means[c].eqNullSafe(keyed[f"__key_{c}"]) for c in b]), "left")
    else:
        joined = attach(means, best, [])
    return joined.select(*b, F.coalesce(f"peak_{x}", "__mx").alias(f"peak_{x}"),
                         F.coalesce(f"peak_{y}", "__my").alias(f"peak_{y}"), "density", "n")
