"""Density clustering (M3, M7, M8, M9) for every group in one job.

Two-dimensional points are clustered by cells of side eps / sqrt(2), any two
points of which are neighbours.  All DataFrame operations:

1. rows -> weighted distinct points per ``by`` group (map-side collapse);
2. a cell whose weight reaches ``min_samples`` holds core points only; the
   points of other cells look at the 24 cells around: one whose box lies within
   eps counts as a whole, one whose box lies beyond it not at all, and only the
   points of the others are compared one by one;
3. the core points of a cell are one node; two cells are linked if two of
   their core points lie within eps.  Extreme points in eight directions show
   most links; only the other cell pairs are compared point by point;
4. components of the cells (``graph.connected_components``);
5. border points join the smallest adjacent core component, others are -1;
6. clusters are numbered per group by ``dense_rank`` of the component's
   smallest point id, minus 1 - deterministic and independent of row order.

No list of neighbour pairs is kept: each comparison ends in an aggregate.
Feature vectors with more dimensions (M8) go the same way (``_feature_cells``).
Labels are joined back to the rows on (by, x, y).
"""

from __future__ import annotations

import itertools
import math
import operator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hotbeat.operators.graph import connected_components
from hotbeat.operators.spatial import _cols, weighted_points
from hotbeat.session import cut_lineage, spread_groups

#: Features that span the grid of cells; the cells a point may reach are at most 5 to this power.
GRID_FEATURES = 3
#: Cells along a side of a block, whose points are one group.
BLOCK = 6
#: Pairs that a task compares at once, and pairs of boxes between two looks at what is joined already.
AT_ONCE = 1 << 18
PAIRS = 1 << 12
_MEMBER, _LINK, _BESIDE = 0, 1, 2


def _around(cells: DataFrame) -> DataFrame:
    """Each row once for every cell within two steps of its own: (tx, ty) is the other cell."""
    step = lambda: F.explode(F.sequence(F.lit(-2), F.lit(2)))
    return (cells.withColumn("ox", step()).withColumn("oy", step())
                 .withColumn("tx", F.col("cx") + F.col("ox")).withColumn("ty", F.col("cy") + F.col("oy")).drop("ox", "oy"))


def _close(ax, ay, bx, by_, eps: float) -> Column:
    return (ax - bx) * (ax - bx) + (ay - by_) * (ay - by_) <= F.lit(eps) * F.lit(eps)


def _cell_points(pts: DataFrame, eps: float, min_samples: int, by: list[str]):
    """(points with cell, node and label of core cells, border labels)."""
    side = eps / math.sqrt(2.0) * (1.0 - 1e-9)
    p = cut_lineage(pts.select(*by, "pid", "w", "ax", "ay", F.floor(F.col("ax") / side).alias("cx"), F.floor(F.col("ay") / side).alias("cy")))
    cell = [*by, "cx", "cy"]
    weights = p.groupBy(*cell).agg(F.sum("w").alias("cw"), *[f(c).alias(n) for c, lo, hi in (("ax", "x0", "x1"), ("ay", "y0", "y1"))
                                                             for f, n in ((F.min, lo), (F.max, hi))])
    dense = weights.filter(F.col("cw") >= min_samples)
    sparse = p.join(weights.filter(F.col("cw") < min_samples).select(*cell, "cw"), cell)  # fewer than min_samples points a cell
    target = [*by, "tx", "ty"]
    there = lambda d, **names: d.select(*by, F.col("cx").alias("tx"), F.col("cy").alias("ty"), *[F.col(k).alias(v) for k, v in names.items()])
    # neighbours of the points of sparse cells: their own cell as a whole, others by distance
    near = (_around(sparse).filter((F.col("tx") != F.col("cx")) | (F.col("ty") != F.col("cy"))).drop("cw")
            .join(there(weights, cw="cw", x0="x0", x1="x1", y0="y0", y1="y1"), target))
    gap = lambda f, c, lo, hi: f(F.col(lo) - F.col(c), F.col(c) - F.col(hi))
    least = lambda c, lo, hi: F.greatest(F.lit(0.0), gap(F.greatest, c, lo, hi))
    most = lambda c, lo, hi: F.greatest(F.abs(F.col(c) - F.col(lo)), F.abs(F.col(c) - F.col(hi)))
    zero = F.lit(0.0)
    whole = _close(most("ax", "x0", "x1"), most("ay", "y0", "y1"), zero, zero, eps)
    near = near.withColumn("whole", whole).filter(_close(least("ax", "x0", "x1"), least("ay", "y0", "y1"), zero, zero, eps * (1 + 1e-9)))
    single = (near.filter(~F.col("whole")).select("pid", *target, "ax", "ay").join(there(p, ax="bx", ay="by_", w="bw"), target)
              .filter(_close(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by_"), eps)).select("pid", "bw"))
    counted = (near.filter("whole").select("pid", F.col("cw").alias("bw")).unionByName(single)
               .groupBy("pid").agg(F.sum("bw").alias("nw")))
    sparse_core = (sparse.join(counted, "pid", "left").filter(F.col("cw") + F.coalesce("nw", F.lit(0)) >= min_samples)
                   .select("pid", *cell, "ax", "ay"))
    core = cut_lineage(p.join(dense, cell).select("pid", *cell, "ax", "ay").unionByName(sparse_core))

    # one node a cell, named by its least core point, with extreme points in eight directions
    ways = [(1, 0), (0, 1), (1, 1), (1, -1)]
    reach = lambda u, v: F.col("ax") * F.lit(float(u)) + F.col("ay") * F.lit(float(v))
    spot = F.struct("ax", "ay")
    nodes = cut_lineage(core.groupBy(*cell).agg(F.min("pid").alias("node"), F.array_distinct(F.array(
        *[f(spot, reach(u, v)) for u, v in ways for f in (F.max_by, F.min_by)])).alias("rim")))
    pairs = (_around(nodes).join(there(nodes, node="node2", rim="rim2"), target).filter(F.col("node") < F.col("node2")))
    linked = F.exists("rim", lambda a: F.exists("rim2", lambda b: _close(a["ax"], a["ay"], b["ax"], b["ay"], eps)))
    pairs = cut_lineage(pairs.select(*cell, "tx", "ty", "node", "node2", linked.alias("sure")))
    open_ = pairs.filter(~F.col("sure"))
    more = (open_.join(core.select(*cell, "ax", "ay"), cell)
            .join(there(core, ax="bx", ay="by_"), target)
            .filter(_close(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by_"), eps)).select("node", "node2").distinct())
    edges = pairs.filter("sure").select("node", "node2").unionByName(more).toDF("src", "dst")
    labels = cut_lineage(connected_components(nodes.select("node"), edges).join(nodes.select("node", *cell), "node"))

    core_labels = core.join(labels.select(*cell, "label"), cell).select("pid", *cell, "ax", "ay", "label")
    rest = _around(sparse.join(core.select("pid"), "pid", "left_anti"))
    border = (rest.join(there(core_labels, ax="bx", ay="by_", label="label"), target)
              .filter(_close(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by_"), eps))
              .groupBy("pid").agg(F.min("label").alias("label")))
    return core_labels.select("pid", "label", F.lit(True).alias("is_core")).unionByName(border.select("pid", "label", F.lit(False).alias("is_core")))


def _expanded(first: np.ndarray, count: np.ndarray):
    """(position, member): every member first .. first + count - 1 of each position, ``AT_ONCE`` or one position's at a time."""
    ends = np.cumsum(count)
    a = 0
    while a < len(count):
        z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + AT_ONCE, side="right")))
        at = np.repeat(np.arange(a, z), count[a:z])
        yield at, first[at] + np.arange(len(at)) - np.repeat(ends[a:z] - count[a:z] - (ends[a - 1] if a else 0), count[a:z])
        a = z


def _summed(d: np.ndarray) -> np.ndarray:
    """Sums of squares of the rows, column by column in their order."""
    out = d[:, 0] * d[:, 0]
    for i in range(1, d.shape[1]):
        out += d[:, i] * d[:, i]
    return out


def _nearest(lo, hi, lo2, hi2) -> np.ndarray:
    """Least squared distances between the boxes [lo, hi] and [lo2, hi2], a row each."""
    return _summed(np.maximum(np.maximum(lo2 - hi, lo - hi2), 0.0))


def _farthest(lo, hi, lo2, hi2) -> np.ndarray:
    return _summed(np.maximum(hi2 - lo, hi - lo2))


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (a root for every box) after joining the boxes ``a`` with the boxes ``b``."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    return label


class _Boxes:
    """Points in boxes: equal cells and equal values of the features that span no grid; any two points of a box are neighbours."""

    def __init__(self, f: np.ndarray, cell: np.ndarray, code: np.ndarray, strides: np.ndarray, k: int):
        self.k, self.strides = k, strides
        self.order = np.lexsort([*f[:, k:].T[::-1], code])
        f, code = f[self.order], code[self.order]
        new = np.ones(len(f), bool)
        if len(f):
            new[1:] = (code[1:] != code[:-1]) | (f[1:, k:] != f[:-1, k:]).any(1)
        self.start = np.flatnonzero(new)
        self.size = np.diff(np.append(self.start, len(f)))
        self.of = np.cumsum(new) - 1  # box of a point
        self.points = f
        self.lo, self.hi = (m.reduceat(f, self.start) if len(f) else f for m in (np.minimum, np.maximum))
        self.code = code[self.start]
        self.places, self.first = np.unique(self.code, return_index=True)
        self.many = np.diff(np.append(self.first, len(self.start)))

    def around(self, code: np.ndarray, reach: int):
        """(position in ``code``, box) for the boxes of all cells within ``reach`` steps of each cell, in pieces, the nearest cells first."""
        for step in sorted(itertools.product(range(-reach, reach + 1), repeat=self.k), key=lambda s: sum(i * i for i in s)):
            want = code + int(np.dot(step, self.strides))
            at = np.minimum(np.searchsorted(self.places, want), max(len(self.places) - 1, 0))
            hit = np.flatnonzero(self.places[at] == want) if len(self.places) else np.zeros(0, np.int64)
            for which, box in _expanded(self.first[at[hit]], self.many[at[hit]]):
                yield hit[which], box

    def members(self, box: np.ndarray):
        """(position in ``box``, point) in pieces; points are numbered in the order of the boxes."""
        yield from _expanded(self.start[box], self.size[box])


def _places(cell: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """One number a cell, and what a step along each feature adds to it."""
    low = cell.min(0) - reach
    sizes = cell.max(0) + reach + 1 - low
    strides = np.append(np.cumprod(sizes[::-1])[::-1][1:], 1).astype(np.int64)
    return (cell - low) @ strides, strides


def _feature_arrays(t: pa.Table, k: int):
    flat = lambda c, kind: t.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(t.num_rows, -1)
    return flat("f", np.float64), flat("cell", np.int64), t.column("own").to_numpy()


def _core_points(t: pa.Table, k: int, reach: int, limit: float, min_samples: int) -> np.ndarray:
    """Which of a block's own points (mask over all rows of ``t``) are core points."""
    f, cell, own = _feature_arrays(t, k)
    code, strides = _places(cell, reach)
    b = _Boxes(f, cell, code, strides, k)
    own, w = own[b.order], t.column("w").to_numpy()[b.order]
    box_weight = np.add.reduceat(w, b.start)
    around, single = np.zeros(len(b.start)), np.zeros(len(f))
    sparse = np.flatnonzero((box_weight < min_samples) & own[b.start])  # fewer than min_samples points a box
    for at, other in b.around(b.code[sparse], reach):
        mine = sparse[at]
        asked = (mine != other) & ((box_weight + around)[mine] < min_samples)
        mine, other = mine[asked], other[asked]
        near = (_nearest(b.lo[mine], b.hi[mine], b.lo[other], b.hi[other]) <= limit)
        mine, other = mine[near], other[near]
        sure = _farthest(b.lo[mine], b.hi[mine], b.lo[other], b.hi[other]) <= limit
        around += np.bincount(mine[sure], box_weight[other[sure]], len(around))
        mine, other = mine[~sure], other[~sure]
        for at2, point in b.members(mine):
            asked = around[mine[at2]] + box_weight[mine[at2]] + single[point] < min_samples
            at2, point = at2[asked], point[asked]
            box, here = other[at2], b.points[point]
            near = _nearest(here, here, b.lo[box], b.hi[box]) <= limit
            box, point = box[near], point[near]
            here = here[near]
            whole = _farthest(here, here, b.lo[box], b.hi[box]) <= limit
            single += np.bincount(point[whole], box_weight[box[whole]], len(single))
            box, point = box[~whole], point[~whole]
            for at3, other_point in b.members(box):
                mine3 = point[at3]
                close = _summed(b.points[mine3] - b.points[other_point]) <= limit
                single += np.bincount(mine3[close], w[other_point[close]], len(single))
    out = np.zeros(len(f), bool)
    out[b.order] = own & ((box_weight + around)[b.of] + single >= min_samples)
    return out


def _local_links(t: pa.Table, k: int, reach: int, limit: float) -> tuple[list[np.ndarray], list[np.ndarray], list[int]]:
    """Rows (kind, from, to) by position in ``t``: every core point of the block with the node of its box (``_MEMBER``), boxes that
    are joined here with one of them (``_LINK``), and other points of the block with the joined boxes beside them (``_BESIDE``).

    A box is one node, named by its least core point.  The boxes of the block are joined with all that lie within eps of them;
    points are compared only where the boxes do not tell, and only of boxes that are not joined yet.
    """
    f, cell, own = _feature_arrays(t, k)
    core = t.column("core").to_numpy()
    code, strides = _places(cell, reach)
    rows = np.flatnonzero(core)
    b = _Boxes(f[core], cell[core], code[core], strides, k)
    rows = rows[b.order]  # row of each point
    rank = np.empty(t.num_rows, np.int64)
    rank[pc.array_sort_indices(t.column("pid").combine_chunks()).to_numpy()] = np.arange(t.num_rows)
    by_rank = np.argsort(rank)
    node = by_rank[np.minimum.reduceat(rank[rows], b.start)] if len(rows) else rows
    mine = own[rows[b.start]] if len(rows) else np.zeros(0, bool)
    label = np.arange(len(b.start))
    inner, open_ = np.flatnonzero(mine), []
    for at, other in b.around(b.code[inner], reach):
        one = inner[at]
        asked = (one < other) | ~mine[other]
        asked &= label[one] != label[other]
        one, other = one[asked], other[asked]
        near = _nearest(b.lo[one], b.hi[one], b.lo[other], b.hi[other]) <= limit
        one, other = one[near], other[near]
        sure = _farthest(b.lo[one], b.hi[one], b.lo[other], b.hi[other]) <= limit
        label = _merged(label, one[sure], other[sure])
        open_.append(np.stack([one[~sure], other[~sure]]))
    open_ = np.concatenate(open_, 1) if open_ else np.zeros((2, 0), np.int64)
    open_ = open_[:, label[open_[0]] != label[open_[1]]]
    for a in range(0, open_.shape[1], PAIRS):
        one, other = open_[:, a:a + PAIRS]
        apart = label[one] != label[other]
        one, other = one[apart], other[apart]
        for at, point in b.members(one):
            box, here = other[at], b.points[point]
            near = (_nearest(here, here, b.lo[box], b.hi[box]) <= limit) & (label[one[at]] != label[box])
            box, point = box[near], point[near]
            for at2, other_point in b.members(box):
                p = point[at2]
                close = _summed(b.points[p] - b.points[other_point]) <= limit
                label = _merged(label, b.of[p[close]], b.of[other_point[close]])
    out = [(rows[own[rows]], node[b.of[own[rows]]], _MEMBER), (node[label != np.arange(len(label))], node[label[label != np.arange(len(label))]], _LINK)]

    outer = np.flatnonzero(own & ~core)
    beside = []
    for at, box in b.around(code[outer], reach):
        here = f[outer[at]]
        near = _nearest(here, here, b.lo[box], b.hi[box]) <= limit
        at, box, here = at[near], box[near], here[near]
        whole = _farthest(here, here, b.lo[box], b.hi[box]) <= limit
        beside.append(np.stack([at[whole], label[box[whole]]]))
        at, box = at[~whole], box[~whole]
        for at2, point in b.members(box):
            p = outer[at[at2]]
            close = _summed(f[p] - b.points[point]) <= limit
            beside.append(np.stack([at[at2[close]], label[b.of[point[close]]]]))
    if beside:
        beside = np.unique(np.concatenate(beside, 1), axis=1)
        out.append((outer[beside[0]], node[beside[1]], _BESIDE))
    return [x for x, _, _ in out], [y for _, y, _ in out], [kind for _, _, kind in out]


def _feature_cells(pts: DataFrame, eps: float, min_samples: int, by: list[str], grid_cols, extra_cols) -> DataFrame:
    """Labels of points with more than two features, by cells as well.

    A cell is a box of side eps / sqrt(k) in the first k <= ``GRID_FEATURES`` features together with the exact
    values of all others, so any two of its points are neighbours.  Between two cells the nearest and the
    farthest distance of the boxes decide; points are compared only where these lie on both sides of eps.

    Blocks of ``BLOCK`` cells a side are the groups: a task has the points of a block and of the cells within
    reach of it, first to find the core points, then to join the boxes of core points.  Only one link a box
    and block leaves it, however many boxes lie within eps of each other.
    """
    grid, rest = list(grid_cols)[:GRID_FEATURES], list(grid_cols)[GRID_FEATURES:] + list(extra_cols)
    k, side, limit = len(grid), eps / math.sqrt(len(grid)) * (1.0 - 1e-9), eps * eps
    reach = int(math.sqrt(k) * (1.0 + 2e-9)) + 1
    key = pts.schema["pid"].dataType.simpleString()
    real = F.array(*[F.col(c).cast("double") for c in grid + rest])
    p = pts.select(*by, "pid", "w", real.alias("f"), F.array(*[F.floor(F.col(c) / side).cast("long") for c in grid]).alias("cell"))
    tasks = max(pts.sparkSession.sparkContext.defaultParallelism, int(pts.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    block = lambda c: F.floor(c / F.lit(BLOCK)).cast("long")
    ends = p.agg(*[f(block(F.col("cell")[i])) for i in range(k) for f in (F.min, F.max)]).first()

    def blocks(d: DataFrame) -> DataFrame:
        """Each row once for its own block and for those that its cell lies within reach of."""
        steps = [f"__b{i}" for i in range(k)]
        for i, b in enumerate(steps):
            low, high = F.lit(ends[2 * i]).cast("long"), F.lit(ends[2 * i + 1]).cast("long")
            d = d.withColumn(b, F.explode(F.sequence(F.greatest(low, block(F.col("cell")[i] - reach)), F.least(high, block(F.col("cell")[i] + reach)))))
        own = reduce(operator.and_, [F.col(b) == block(F.col("cell")[i]) for i, b in enumerate(steps)])
        d = d.withColumn("own", own)
        d = d.where("core OR own") if "core" in d.columns else d  # other points look for core points from their own block only
        return spread_groups(d, [*by, *steps], tasks).groupBy(*by, *steps)

    names = [*by, "pid", "w", "f", "cell"]
    types = ", ".join(f"`{c}` {pts.schema[c].dataType.simpleString()}" for c in by)

    def find(t: pa.Table) -> pa.Table:
        if not pc.any(t.column("own")).as_py():
            return t.select(names).append_column("core", t.column("own")).slice(0, 0)
        core = _core_points(t, k, reach, limit, min_samples)
        return t.select(names).append_column("core", pa.array(core)).filter(t.column("own"))

    kinds = pts.schema["w"].dataType.simpleString()
    cored = cut_lineage(blocks(p).applyInArrow(find, f"{types}, pid {key}, w {kinds}, f array<double>, cell array<long>, core boolean"))

    def join(t: pa.Table) -> pa.Table:
        if not pc.any(t.column("own")).as_py():
            t = t.slice(0, 0)
        one, other, kind = _local_links(t, k, reach, limit) if t.num_rows else ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [_LINK])
        pid = t.column("pid").combine_chunks()
        marks = np.concatenate([np.full(len(x), n) for x, n in zip(one, kind)])
        return pa.table([pa.array(marks, pa.int32()), pid.take(pa.array(np.concatenate(one))), pid.take(pa.array(np.concatenate(other)))],
                        names=["kind", "src", "dst"])

    found = cut_lineage(blocks(cored).applyInArrow(join, f"kind int, src {key}, dst {key}"))
    kind = lambda n: found.where(F.col("kind") == n).select("src", "dst")
    members = kind(_MEMBER).toDF("pid", "node")
    labels = cut_lineage(connected_components(members.select("node"), kind(_LINK)))
    inner = members.join(labels, "node").select("pid", "label", F.lit(True).alias("is_core"))
    border = (kind(_BESIDE).toDF("pid", "node").join(labels, "node").groupBy("pid").agg(F.min("label").alias("label"))
              .select("pid", "label", F.lit(False).alias("is_core")))
    return inner.unionByName(border)


def dbscan_points(pts: DataFrame, eps: float, min_samples: int, by=None,
                  x: str = "lat", y: str = "lon", grid_cols=None, extra_cols=()) -> DataFrame:
    """Cluster weighted distinct points -> (by, coords, pid, w, is_core, cluster).

    Default: 2-d points (x, y), by cells.  ``grid_cols`` / ``extra_cols``
    switch to d-dimensional features (M8).
    """
    by = _cols(by)
    if not by:
        pts, by, tmp = pts.withColumn("__g", F.lit(0)), ["__g"], True
    else:
        tmp = False
    if grid_cols:
        labels = _feature_cells(pts, eps, min_samples, by, grid_cols, extra_cols)
    else:
        labels = _cell_points(pts.withColumn("ax", F.col(x)).withColumn("ay", F.col(y)), eps, min_samples, by)
    out = pts.join(labels, "pid", "left").fillna(False, ["is_core"])
    # number the components per group; window rows = components of one group
    lab = labels.filter("is_core").join(pts.select("pid", *by), "pid").select(*by, "label").distinct()
    lab = lab.withColumn("cluster", (F.dense_rank().over(Window.partitionBy(*by).orderBy("label")) - 1).cast("int"))
    out = (out.join(lab, by + ["label"], "left")
              .withColumn("cluster", F.coalesce("cluster", F.lit(-1)))
              .drop("label"))
    return out.drop("__g") if tmp else out


def dbscan(df: DataFrame, eps: float, min_samples: int, by=None, x: str = "lat", y: str = "lon",
           id_col: str = "incident_id", out: str = "cluster") -> DataFrame:
    """M7: label every row with its density cluster (noise = -1).

    Null groups are groups like any; rows with a null coordinate are noise.
    """
    by = _cols(by)
    rows = df.withColumn("__by", F.struct(*by)) if by else df  # a struct equals another whose fields are null alike
    keys = ["__by"] if by else []
    pts = weighted_points(rows, keys, x, y, id_col)
    lab = dbscan_points(pts, eps, min_samples, keys, x, y).select(*keys, x, y, F.col("cluster").alias(out))
    return rows.join(lab, keys + [x, y], "left").fillna(-1, [out]).drop("__by")


def density_outliers(df: DataFrame, eps: float, min_samples: int = 2, by=None,
                     x: str = "lat", y: str = "lon", id_col: str = "incident_id") -> DataFrame:
    """M3: rows that density clustering leaves as noise."""
    return dbscan(df, eps, min_samples, by, x, y, id_col, out="outlier_cluster").filter(
        F.col("outlier_cluster") == -1)


def dbscan_features(df: DataFrame, eps: float, min_samples: int, grid_cols, extra_cols=(), by=None,
                    id_col: str = "incident_id", out: str = "cluster") -> DataFrame:
    """M8: density clustering on mixed numeric + one-hot features.

    Rows with a null feature are left out of the clustering and labelled -1; null groups are groups like any.
    """
    feats = list(grid_cols) + list(extra_cols)
    rows = df.withColumn("__by", F.struct(*_cols(by))) if by else df
    keys = ["__by"] if by else []
    pts = cut_lineage(rows.na.drop(subset=feats).groupBy(*keys, *feats).agg(F.count(F.lit(1)).alias("w"), F.min(id_col).alias("pid")))
    lab = dbscan_points(pts, eps, min_samples, keys or None, grid_cols=grid_cols, extra_cols=extra_cols)
    lab = lab.select(*keys, *feats, F.col("cluster").alias(out))
    return rows.join(lab, keys + feats, "left").fillna(-1, [out]).select(*df.columns, out)
