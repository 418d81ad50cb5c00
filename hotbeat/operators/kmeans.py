"""Keyed k-means (M4), assignment to fixed centres (M5), elbow (M6),
K-prototypes for mixed data (M14).

One plan clusters every group and every k at once:
* points are weighted distinct feature vectors (map-side collapse), stored once whatever the number of ks;
* the centres of a (group, k) are one array in a small table of the shared folder; every round joins it to
  the points on the group (broadcast or not is the planner's choice by the table's size) and writes its
  successor: one job, one aggregate of weighted sums, whatever the number of groups;
* assignment is ``array_min`` over ``transform`` of that array: JVM-side, no points x centres rows;
* (group, k) pairs whose centres stay are left out of later rounds;
* seeding oversamples: in five rounds every point is drawn with probability 2k w D^2 / cost, and weighted
  k-means++ picks k of the few candidates.
"""

from __future__ import annotations

import math
import operator
import warnings
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hotbeat.session import cut_lineage, drop_path, scratch_path

#: Rounds of oversampling, and candidates drawn a round for each wanted centre (expected).
SEED_ROUNDS = 5
OVERSAMPLING = 2


def _as_list(by) -> list[str]:
    if not by:
        return []
    return [by] if isinstance(by, str) else list(by)


def collapse(df: DataFrame, cols: Sequence[str], by=None, weight: str | None = None,
             id_col: str = "incident_id") -> DataFrame:
    """Weighted distinct points: (by, cols, w, pid)."""
    w = F.sum(weight) if weight else F.count(F.lit(1))
    return (df.groupBy(*_as_list(by), *cols).agg(w.cast("double").alias("w"), F.min(id_col).alias("pid"))
              .filter(F.col("w") > 0))


def _uniform(pid: Column, seed: int, j: int) -> Column:
    """Deterministic u in (0, 1) from a hash of (pid, seed, pass)."""
    h = F.pmod(F.xxhash64(pid, F.lit(seed), F.lit(j)), F.lit(1 << 52)).cast("double")
    return (h + F.lit(0.5)) / F.lit(float(1 << 52))


def _dist2(cols: Sequence[str], c: Column) -> Column:
    e = None
    for i, name in enumerate(cols):
        t = (F.col(name) - c.getField(f"v{i}")) * (F.col(name) - c.getField(f"v{i}"))
        e = t if e is None else e + t
    return e


def _nearest(cols: Sequence[str], arr: str = "__centres") -> Column:
    """struct(d2, cluster) of the nearest centre in the array column ``arr``."""
    return F.array_min(F.transform(F.col(arr), lambda c: F.struct(_dist2(cols, c).alias("d2"),
                                                                c.getField("cluster").alias("cluster"))))


def _centre_struct(cols: Sequence[str], prefix: str = "") -> Column:
    return F.struct(F.col("cluster").cast("int").alias("cluster"),
                    *[F.col(f"{prefix}{c}").cast("double").alias(f"v{i}") for i, c in enumerate(cols)])


def _null_safe(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names, null being a value like any; the right side's copies are dropped."""
    other = right.select(*[F.col(c).alias(f"__r_{c}") if c in names else F.col(c) for c in right.columns])
    on = [left[c].eqNullSafe(other[f"__r_{c}"]) for c in names]
    return left.join(other, on, how).drop(*[f"__r_{c}" for c in names])


class Kept:
    """A small table that each round rewrites: ``df`` reads the latest version, older ones are deleted."""

    def __init__(self, spark, name: str):
        self.spark, self.name, self.path, self.df = spark, name, None, None

    def put(self, df: DataFrame, count: Column | None = None) -> int:
        """Writes the next version; returns how many of its rows fulfil ``count``."""
        seen = Observation()
        path = scratch_path(self.spark, self.name)
        df.observe(seen, F.count(F.when(F.lit(True) if count is None else count, 1)).alias("n")).write.parquet(path)
        if self.path:
            drop_path(self.spark, self.path)
        self.path, self.df = path, self.spark.read.schema(df.schema).parquet(path)
        return seen.get["n"]


def _point_struct(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])


def _plus_plus(points: np.ndarray, w: np.ndarray, k: int, rng) -> np.ndarray:
    """Weighted k-means++ over a few candidates: at most k distinct ones."""
    chosen = [int(rng.choice(len(points), p=w / w.sum()))]
    d = ((points - points[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k and (d * w).sum() > 0:
        n = int(rng.choice(len(points), p=d * w / (d * w).sum()))
        chosen.append(n)
        d = np.minimum(d, ((points - points[n]) ** 2).sum(1))
    return points[chosen]


def seed_centres(pts: DataFrame, cols: Sequence[str], ks: Sequence[int], b: list[str], seed: int = 42) -> DataFrame:
    """(b, __k, __p): at most k start centres of every group and k, by oversampling.

    All ks share the candidates of their group, about ``OVERSAMPLING`` x largest k x ``SEED_ROUNDS``.
    """
    most = max(ks)
    cand = Kept(pts.sparkSession, "candidates")
    first = F.min_by(_point_struct(cols), -F.log(_uniform(F.col("pid"), seed, 0)) / F.col("w"))
    spread = F.sum("w") * sum([F.coalesce(F.var_pop(c), F.lit(0.0)) for c in cols], F.lit(0.0))
    cand.put(pts.groupBy(*b).agg(F.array(first).alias("__c"), spread.alias("__phi")))
    for r in range(1, SEED_ROUNDS + 1):
        # the cost of the round before stands for this one's: one pass draws and adds up the next cost
        d2 = F.array_min(F.transform("__c", lambda c: _dist2(cols, c)))
        a = _null_safe(pts, cand.df, b).withColumn("__d", F.col("w") * d2)
        drawn = F.when((F.col("__d") > 0) & (_uniform(F.col("pid"), seed, r) * F.col("__phi") < OVERSAMPLING * most * F.col("__d")), _point_struct(cols))
        cand.put(a.groupBy(*b).agg(F.first("__c").alias("__o"), F.sort_array(F.collect_list(drawn)).alias("__n"), F.sum("__d").alias("__phi"))
                 .select(*b, F.concat("__o", "__n").alias("__c"), "__phi"))
    near = F.array_min(F.transform("__c", lambda c, i: F.struct(_dist2(cols, c).alias("d"), i.alias("i")))).getField("i")
    weights = (_null_safe(pts, cand.df, b).select(*b, F.col("__c")[near].alias("__at"), "w")
               .groupBy(*b, "__at").agg(F.sum("w").alias("w")).select(*b, "__at.*", "w"))
    keyed = weights.withColumn("__k", F.explode(F.array(*[F.lit(k) for k in ks])))
    names = [f"v{i}" for i in range(len(cols))]

    def pick(t: pa.Table) -> pa.Table:
        k = t.column("__k")[0].as_py()
        x, w = np.stack([t.column(n).to_numpy() for n in names], 1), t.column("w").to_numpy()
        order = np.lexsort(x.T[::-1])
        centres = _plus_plus(x[order], w[order], k, np.random.default_rng([seed, k]))
        lists = [{"cluster": i, **dict(zip(names, map(float, c)))} for i, c in enumerate(centres)]
        kind = pa.list_(pa.struct([("cluster", pa.int32()), *[(n, pa.float64()) for n in names]]))
        return pa.table([*[t.column(c).slice(0, 1) for c in b], pa.array([k], pa.int32()), pa.array([lists], kind)], names=[*b, "__k", "__p"])

    types = [f"`{c}` {pts.schema[c].dataType.simpleString()}" for c in b] + ["__k int", f"__p array<struct<cluster:int,{','.join(f'{n}:double' for n in names)}>>"]
    return keyed.groupBy(*b, "__k").applyInArrow(pick, ", ".join(types))


def _centre_distance(cols: Sequence[str]):
    return lambda c: F.struct(_dist2(cols, c).alias("d2"), c.getField("cluster").alias("cluster"))


def _lloyd_round(pts: DataFrame, state: DataFrame, cols: Sequence[str], b: list[str]) -> DataFrame:
    """The state after one round; ``active`` where a centre moved by more than the group's limit."""
    key = b + ["__k"]
    a = _null_safe(pts, state.where("active").select(*key, "__p"), b)
    a = a.withColumn("cluster", F.array_min(F.transform("__p", _centre_distance(cols))).getField("cluster"))
    sums = a.groupBy(*key, "cluster").agg(*[(F.sum(F.col(c) * F.col("w")) / F.sum("w")).alias(f"v{i}") for i, c in enumerate(cols)])
    names = [f"v{i}" for i in range(len(cols))]
    new = sums.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("cluster", F.struct("cluster", *names)))).alias("__m"))
    # clusters that lost every point keep their old centre
    merged = _null_safe(state.where("active"), new, key).withColumn("__new", F.transform("__p", lambda p: F.coalesce(F.col("__m")[p.getField("cluster")], p)))
    shift = F.array_max(F.zip_with("__p", "__new", lambda p, q: sum([(p.getField(n) - q.getField(n)) * (p.getField(n) - q.getField(n)) for n in names], F.lit(0.0))))
    return (merged.select(*key, F.col("__new").alias("__p"), "__limit", (shift > F.col("__limit")).alias("active"))
            .unionByName(state.where("NOT active")))


def _fit(pts: DataFrame, cols: Sequence[str], ks: Sequence[int], b: list[str], seed: int, max_iter: int, tol: float) -> DataFrame:
    """(b, __k, __p) after weighted Lloyd rounds: until no centre of a group moves, squared, by more than
    ``tol`` times its mean variance (or what the order of sums can do)."""
    variance = sum([F.coalesce(F.var_pop(c), F.lit(0.0)) for c in cols], F.lit(0.0)) / len(cols)
    noise = reduce(F.greatest, [F.max(F.abs(F.col(c))) for c in cols]) if len(cols) > 1 else F.max(F.abs(F.col(cols[0])))
    limits = pts.groupBy(*b).agg(F.greatest(tol * variance, 1e-24 * noise * noise).alias("__limit"))
    state = Kept(pts.sparkSession, "centres")
    start = _null_safe(seed_centres(pts, cols, ks, b, seed), limits, b)
    state.put(start.select(*b, "__k", "__p", "__limit", F.lit(True).alias("active")))
    for _ in range(max_iter):
        if state.put(_lloyd_round(pts, state.df, cols, b), F.col("active")) == 0:
            break
    else:
        warnings.warn(f"k-means centres still moving after {max_iter} rounds", RuntimeWarning, stacklevel=3)
    return state.df.select(*b, "__k", "__p")


def _points(df: DataFrame, cols: Sequence[str], b: list[str], weight: str | None, id_col: str) -> DataFrame:
    known = reduce(operator.and_, [F.col(c).isNotNull() for c in cols])
    return cut_lineage(collapse(df.where(known), cols, b, weight, id_col))


def assign(df: DataFrame, centres: DataFrame, cols: Sequence[str], by=None,
           out: str = "cluster", dist: str | None = None) -> DataFrame:
    """M5: nearest centre (ties to the smaller cluster id) for every row.

    ``centres``: (by, cluster, cols), packed to one row per group.  Null groups are groups like any; rows
    whose group has no centres are left out, rows with a null coordinate get a null cluster.
    """
    by = _as_list(by)
    if by:
        r = _null_safe(df, centres.groupBy(*by).agg(F.collect_list(_centre_struct(cols)).alias("__centres")), by)
    else:
        # one centre list for everything: a scalar subquery, not a join
        arr = centres.agg(F.collect_list(_centre_struct(cols))).scalar()
        r = df.withColumn("__centres", arr)
    known = reduce(operator.and_, [F.col(c).isNotNull() for c in cols])
    r = r.withColumn("__near", F.when(known, _nearest(cols)))
    r = r.withColumn(out, F.col("__near.cluster"))
    if dist:
        r = r.withColumn(dist, F.col("__near.d2"))
    return r.drop("__centres", "__near")


def kmeans(df: DataFrame, cols: Sequence[str], k: int, by=None, seed: int = 42, max_iter: int = 300,
           tol: float = 1e-4, weight: str | None = None, id_col: str = "incident_id") -> DataFrame:
    """M4: centres (by, cluster, cols, size, wcss) of weighted k-means per group.

    A group with fewer than k distinct points has as many centres; rows with a null coordinate take no part.
    """
    by = _as_list(by)
    b = by or ["__g"]
    pts = _points(df if by else df.withColumn("__g", F.lit(0)), cols, b, weight, id_col)
    packed = _fit(pts, cols, [int(k)], b, seed, max_iter, tol).drop("__k")
    near = F.array_min(F.transform("__p", _centre_distance(cols)))
    stats = (_null_safe(pts, packed, b).select(*b, near.alias("__n"), "w").select(*b, "__n.*", "w")
             .groupBy(*b, "cluster").agg(F.sum("w").alias("size"), F.sum(F.col("w") * F.col("d2")).alias("wcss")))
    centres = packed.select(*b, F.inline("__p")).toDF(*b, "cluster", *cols)
    out = _null_safe(centres, stats, b + ["cluster"], "left").fillna(0, ["size", "wcss"])
    return out if by else out.drop("__g")


def kmeans_labels(df: DataFrame, cols: Sequence[str], k: int, by=None, out: str = "cluster", **kw) -> DataFrame:
    """M4: fit per group and label every row."""
    centres = cut_lineage(kmeans(df, cols, k, by, **kw))
    return assign(df, centres.select(*_as_list(by), "cluster", *cols), cols, by, out)


def elbow(df: DataFrame, cols: Sequence[str], ks: Sequence[int], by=None, seed: int = 42, max_iter: int = 300,
          tol: float = 1e-4, id_col: str = "incident_id") -> DataFrame:
    """M6: total within-cluster sum of squares for each k, per group, in one keyed fit: (by, k, wcss).

    k = 1 is the closed form (sum of squared deviations from the mean).
    """
    by = _as_list(by)
    ks = sorted(set(int(k) for k in ks))
    multi = [k for k in ks if k > 1]
    parts = []
    if 1 in ks:
        g = df.groupBy(*by).agg(*[F.var_pop(c).alias(f"__v{i}") for i, c in enumerate(cols)],
                                F.count(F.lit(1)).alias("__n"))
        parts.append(g.select(*by, F.lit(1).alias("k"),
                              (F.col("__n") * sum(F.col(f"__v{i}") for i in range(len(cols)))).alias("wcss")))
    if multi:
        b = by or ["__g"]
        pts = _points(df if by else df.withColumn("__g", F.lit(0)), cols, b, None, id_col)
        state = _fit(pts, cols, multi, b, seed, max_iter, tol)
        near = F.array_min(F.transform("__p", _centre_distance(cols)))
        parts.append(_null_safe(pts, state, b).groupBy(*b, "__k").agg(F.sum(F.col("w") * near.getField("d2")).alias("wcss"))
                     .select(*by, F.col("__k").alias("k"), "wcss"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- K-prototypes

def _normal(pid: Column, seed: int, j: int) -> Column:
    """Deterministic standard normal number from a hash of (pid, seed, j)."""
    return F.sqrt(-2 * F.log(_uniform(pid, seed, 2 * j))) * F.cos(F.lit(2 * math.pi) * _uniform(pid, seed, 2 * j + 1))


def cao_start(pts: DataFrame, cats: Sequence[str], k: int, by: list[str]) -> DataFrame:
    """Frequency-based start (Cao): (by, cluster, cats), k rows a group.

    The density of a combination of categories is the mean share of the rows with each of its
    values.  The densest is first; each next one has the largest (least mismatches with those chosen x
    density).  Ties go to the smaller combination; combinations repeat when fewer than k exist.
    """
    combos = pts.groupBy(*by, *cats).agg(F.sum("w").alias("w"))
    dens = _null_safe(combos, combos.groupBy(*by).agg(F.sum("w").alias("__n")), by)
    for i, c in enumerate(cats):
        share = combos.groupBy(*by, c).agg(F.sum("w").alias(f"__s{i}")).withColumnRenamed(c, "__v")
        on = [dens[x].eqNullSafe(share[x]) for x in by] + [dens[c].eqNullSafe(share["__v"])]
        dens = dens.join(share, on).select(*[dens[x] for x in dens.columns], f"__s{i}")
    total = sum((F.col(f"__s{i}") for i in range(len(cats))), F.lit(0.0))
    left = dens.select(*by, *cats, (total / (F.lit(max(len(cats), 1)) * F.col("__n"))).alias("__d"),
                       F.lit(float(len(cats) + 1)).alias("__m"), F.array().cast("array<int>").alias("__at"))
    for j in range(k):
        left = cut_lineage(left)
        best = F.struct((-F.col("__m") * F.col("__d")).alias("a"), *cats)
        row = left.groupBy(*by).agg(F.min(best).alias("__p")).select(*by, *[F.col(f"__p.{c}").alias(f"__o_{c}") for c in cats])
        miss = sum((F.when(F.col(c).eqNullSafe(F.col(f"__o_{c}")), 0.0).otherwise(1.0) for c in cats), F.lit(0.0))
        left = (_null_safe(left, row, by).withColumn("__m", F.least("__m", miss))
                .withColumn("__at", F.when(miss == 0, F.array_append("__at", F.lit(j))).otherwise(F.col("__at")))
                .drop(*[f"__o_{c}" for c in cats]))
    return left.select(*by, F.explode("__at").alias("cluster"), *cats)


def default_gamma(df: DataFrame, nums: Sequence[str]) -> float:
    """Half the mean standard deviation of the numbers: the usual weight of one mismatch."""
    sds = df.agg(*[F.stddev_samp(c) for c in nums], F.lit(0)).first()[:len(nums)]
    return 0.5 * (sum(float(s or 0.0) for s in sds) / max(len(nums), 1))


def _prototype_cost(nums: Sequence[str], cats: Sequence[str], gamma: float):
    """Prototype struct -> struct(d, cluster) of the row at hand."""
    def cost(p: Column) -> Column:
        num = sum([(F.col(c) - p.getField(f"n{i}")) ** 2 for i, c in enumerate(nums)], F.lit(0.0))
        cat = sum([F.when(F.col(c).eqNullSafe(p.getField(f"c{i}")), 0.0).otherwise(1.0) for i, c in enumerate(cats)], F.lit(0.0))
        return F.struct((num + F.lit(gamma) * cat).alias("d"), p.getField("cluster").alias("cluster"))
    return cost


def _prototype_round(pts: DataFrame, state: DataFrame, nums: Sequence[str], cats: Sequence[str], b: list[str], gamma: float) -> DataFrame:
    """The state after one round: (b, __init, __p, active), active where a prototype moved.

    One aggregate over the points adds, for every cluster and combination of categories, weights and weighted
    numbers; the weights of single values, means and modes come from its rows, not from the points.
    """
    key = b + ["__init"]
    a = _null_safe(pts, state.where("active").select(*key, "__p"), b)
    a = a.withColumn("cluster", F.array_min(F.transform("__p", _prototype_cost(nums, cats, gamma))).getField("cluster"))
    a = a.groupBy(*key, "cluster", *cats).agg(F.sum("w").alias("w"), *[F.sum(F.col("w") * F.col(c)).alias(f"__s{i}") for i, c in enumerate(nums)])
    none = [F.lit(0.0).alias(f"s{i}") for i in range(len(nums))]
    parts = [F.struct(F.lit(-1).alias("col"), F.lit(None).cast("string").alias("value"), F.col("w"),
                      *[F.col(f"__s{i}").alias(f"s{i}") for i in range(len(nums))])]
    parts += [F.struct(F.lit(j).alias("col"), F.col(c).alias("value"), F.col("w"), *none) for j, c in enumerate(cats)]
    counted = (a.select(*key, "cluster", F.explode(F.array(*parts)).alias("x")).select(*key, "cluster", "x.*")
               .groupBy(*key, "cluster", "col", "value").agg(F.sum("w").alias("w"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(nums))]))
    mean = [F.max(F.when(F.col("col") == -1, F.col(f"s{i}") / F.col("w"))).alias(f"n{i}") for i in range(len(nums))]
    mode = [F.max_by("value", F.when(F.col("col") == j, F.struct("w", "value"))).alias(f"c{j}") for j in range(len(cats))]
    fields = ["cluster", *[f"n{i}" for i in range(len(nums))], *[f"c{j}" for j in range(len(cats))]]
    new = (counted.groupBy(*key, "cluster").agg(*mean, *mode)
           .groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("cluster", F.struct(*fields)))).alias("__m")))
    # clusters that lost every point keep their prototype
    merged = _null_safe(state.where("active"), new, key).withColumn("__new", F.transform("__p", lambda p: F.coalesce(F.col("__m")[p.getField("cluster")], p)))
    # sums differ in their last bits with the order of rows
    apart = [lambda p, q, i=i: F.abs(p.getField(f"n{i}") - q.getField(f"n{i}")) > 1e-9 for i in range(len(nums))]
    apart += [lambda p, q, j=j: ~p.getField(f"c{j}").eqNullSafe(q.getField(f"c{j}")) for j in range(len(cats))]
    moved = F.exists(F.zip_with("__p", "__new", lambda p, q: reduce(operator.or_, [f(p, q) for f in apart])), lambda m: m)
    return merged.select(*key, F.col("__new").alias("__p"), moved.alias("active")).unionByName(state.where("NOT active"))


def kprototypes(df: DataFrame, nums: Sequence[str], cats: Sequence[str], k: int, by=None,
                gamma: float | None = None, n_init: int = 5, max_iter: int = 100, seed: int = 42,
                id_col: str = "incident_id") -> DataFrame:
    """K-prototypes (Huang) per group -> all rows with ``cluster``.

    Cost = sum of squared numeric differences + gamma * categorical mismatches.  Prototypes: numeric mean
    and categorical mode per cluster (ties to the larger value).  Categories start by frequency
    (``cao_start``), numbers by normal draws with the group's mean and sd.  ``n_init`` starts run as an extra
    key; of each group the start with the lowest cost is kept.  Keys whose prototypes stay are not computed
    again; a warning tells if some still move after ``max_iter`` rounds.

    Null categories and groups are values like any; rows with a null number have no distance and get a null
    cluster.  Prototypes (groups x starts x k) are a table of the shared folder that each round joins and
    rewrites; whether it is broadcast is the planner's choice by its size.
    """
    by = _as_list(by)
    b = by or ["__g"]
    base = df if by else df.withColumn("__g", F.lit(0))
    if gamma is None:
        gamma = default_gamma(base, nums)
    coded = [f"__c{j}" for j in range(len(cats))]
    key = b + ["__init"]
    rows = base.select(*base.columns, *[F.col(c).cast("string").alias(x) for c, x in zip(cats, coded)])
    known = reduce(operator.and_, [F.col(c).isNotNull() for c in nums], F.lit(True))
    pts = cut_lineage(collapse(rows.where(known), [*nums, *coded], b, None, id_col))
    state = Kept(df.sparkSession, "prototypes")
    moments = pts.groupBy(*b).agg(*[x for i, c in enumerate(nums) for x in (
        (F.sum(F.col(c) * F.col("w")) / F.sum("w")).alias(f"__m{i}"),
        (F.sum(F.col(c) * F.col(c) * F.col("w")) / F.sum("w")).alias(f"__q{i}"))], F.lit(1).alias("__one"))
    where = F.xxhash64(*b, "__init", "cluster")
    draws = [(F.col(f"__m{i}") + _normal(where, seed, i) * F.sqrt(F.greatest(F.lit(0.0), F.col(f"__q{i}") - F.col(f"__m{i}") ** 2))).alias(f"n{i}")
             for i in range(len(nums))]
    first = F.struct(F.col("cluster").cast("int").alias("cluster"), *draws, *[F.col(x).alias(f"c{j}") for j, x in enumerate(coded)])
    state.put(_null_safe(cao_start(pts, coded, k, b), moments, b)
              .withColumn("__init", F.explode(F.sequence(F.lit(0), F.lit(n_init - 1))))
              .groupBy(*key).agg(F.sort_array(F.collect_list(first)).alias("__p")).withColumn("active", F.lit(True)))
    for _ in range(max_iter):
        if state.put(_prototype_round(pts, state.df, nums, coded, b, gamma), F.col("active")) == 0:
            break
    else:
        warnings.warn(f"k-prototypes still moving after {max_iter} rounds", RuntimeWarning, stacklevel=2)
    best = F.array_min(F.transform("__p", _prototype_cost(nums, coded, gamma)))
    costs = _null_safe(pts, state.df.select(*key, "__p"), b).groupBy(*key).agg(F.sum(F.col("w") * best.getField("d")).alias("__cost"))
    chosen = costs.groupBy(*b).agg(F.min_by("__init", F.struct("__cost", "__init")).alias("__init"))
    final = Kept(df.sparkSession, "chosen-prototypes")
    final.put(_null_safe(state.df.select(*key, "__p"), chosen, key).drop("__init"))
    out = _null_safe(rows, final.df, b, "left")
    return out.withColumn("cluster", F.when(known, best.getField("cluster"))).drop("__p", *coded, *([] if by else ["__g"]))
