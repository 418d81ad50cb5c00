"""Histogram trees for many settings, folds and classes at once.

Columns are binned once; the rows collapse to *cells*, the distinct combinations of bins with their number
of rows per label and fold (one aggregate over the whole table).  A cell is all that a histogram tree can
tell about its rows, so training on cells equals training on the rows; every cell is trained on.  Every
(setting, fold) is then a key of its own: Spark deals the packed cells to the keys, each task grows the
trees of its keys level by level from histograms, and scores the held-out cells while it goes.  What cells
of several folds share (the node they fall into, their score) is kept once a combination of bins.  Trees of
fewer rounds, and forests of less depth, are prefixes of larger ones and are scored on the way.  Models are
node tables: saved, reread and counted like any DataFrame.

* ``forest``: gini, bootstrap rows, square root of the columns a node, class weights, smallest split and leaf.
* ``gradient``: first-order boosting of class residuals (leaf (K-1)/K * sum r / sum |r|(1-|r|)), smallest
  leaf as a fraction of all rows.
* ``newton``: second-order boosting of softmax loss: leaves -G / (H + lambda), gain with lambda and gamma,
  smallest sum of hessians a child.
* ``leafwise``: second-order boosting that opens the leaf with the largest gain next.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hotbeat.session import scratch_path, spread_groups

#: Bins of a numeric column.
BINS = 32
#: Combinations of bins whose class a predicting task remembers; beyond it, it starts anew.
REMEMBERED = 200_000
#: Trees of a forest that are grown side by side.
TREES_TOGETHER = 10


@dataclass(frozen=True)
class Columns:
    """Binned columns: numeric ones split at cut points, categorical ones one level against the rest.

    The first level of a categorical column has no indicator, as with dummy columns that drop it.
    """

    names: tuple[str, ...]
    numeric: tuple[bool, ...]
    cuts: tuple[tuple, ...]  # cut points of a numeric column, levels of a categorical one

    def sizes(self) -> np.ndarray:
        return np.array([len(c) + n for c, n in zip(self.cuts, self.numeric)])

    def bin_expr(self, k: int):
        """Bin of a row: cut points below the value, or the level's number (null where there is none)."""
        c = F.col(self.names[k])
        if self.numeric[k]:
            below = F.size(F.filter(F.array(*[F.lit(float(x)) for x in self.cuts[k]]), lambda x: x < c.cast("double"))) \
                if self.cuts[k] else F.lit(0)
            return F.when(c.isNotNull() & ~F.isnan(c.cast("double")), below).cast("int")
        levels = F.array(*[F.lit(x) for x in self.cuts[k]])
        return F.when(F.array_contains(levels, c), F.array_position(levels, c) - 1).cast("int")


def fit_columns(df: DataFrame, numeric: Sequence[str], categorical: dict[str, Sequence], bins: int = BINS) -> Columns:
    """Cut points of the numeric columns (one aggregate); the levels of the others are given."""
    steps = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), steps, 10_000).alias(f"c{i}") for i, c in enumerate(numeric)],
                 F.lit(0).alias("one")).first()
    cuts = [tuple(sorted(set(row[f"c{i}"] or []))) for i in range(len(numeric))]
    levels = [tuple(v) for v in categorical.values()]
    return Columns((*numeric, *categorical), (True,) * len(numeric) + (False,) * len(levels), (*cuts, *levels))


def cells(df: DataFrame, columns: Columns, label: str, classes: int, fold: str | None = None) -> DataFrame:
    """(x, fold, w): bins, fold and rows per label of every distinct combination.

    Rows without a label 0 .. classes - 1 or with a value that has no bin take no part; a null fold counts
    as -1.
    """
    x = F.array(*[columns.bin_expr(k) for k in range(len(columns.names))])
    d = df.select(x.alias("x"), F.col(label).cast("int").alias("y"), (F.coalesce(F.col(fold).cast("int"), F.lit(-1)) if fold else F.lit(-1)).alias("fold"))
    d = d.where(F.col("y").between(0, classes - 1) & ~F.exists("x", lambda v: v.isNull()))
    return d.groupBy("x", "fold").agg(F.array(*[F.count(F.when(F.col("y") == k, 1)) for k in range(classes)]).alias("w"))


# ---------------------------------------------------------------- growing trees from histograms


def _histograms(bins: list[np.ndarray], sizes: np.ndarray, key: np.ndarray, keys: int, stats: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Per column, sums of every statistic by (key, bin); all arrays run over the same rows."""
    out = []
    for x, b in zip(bins, sizes.tolist()):
        at = key * b + x
        sums: dict[int, np.ndarray] = {}  # a statistic that is given twice is added up once
        for s in stats:
            if id(s) not in sums:
                sums[id(s)] = np.bincount(at, s, keys * b).reshape(keys, b)
        out.append([sums[id(s)] for s in stats])
    return out


def _candidates(hist: list[list[np.ndarray]], numeric: Sequence[bool]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(left sums of every statistic, column, bin) over all candidate splits: arrays (key, candidate).

    A numeric split sends bins up to b left; a categorical one sends level b right.
    """
    left: list[list[np.ndarray]] = [[] for _ in hist[0]]
    column, where = [], []
    for f, (stats, ordered) in enumerate(zip(hist, numeric)):
        b = stats[0].shape[1]
        if b < 2:
            continue
        for parts, s in zip(left, stats):
            parts.append(np.cumsum(s, 1)[:, :-1] if ordered else s.sum(1, keepdims=True) - s[:, 1:])
        column += [f] * (b - 1)
        where += list(range(b - 1)) if ordered else list(range(1, b))
    keys = hist[0][0].shape[0]
    return [np.hstack(p) if p else np.zeros((keys, 0)) for p in left], np.array(column, int), np.array(where, int)


def _gains(left: list[np.ndarray], total: list[np.ndarray], outputs: int, ridge: float):
    """Sum over outputs of GL^2/(HL+r) + GR^2/(HR+r) - G^2/(H+r); statistics are outputs, then H."""
    with np.errstate(divide="ignore", invalid="ignore"):
        hl, h = left[outputs], total[outputs][:, None]
        gain = 0.0
        for gl, g in zip(left[:outputs], total[:outputs]):
            g = g[:, None]
            gain = gain + gl * gl / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g * g / (h + ridge)
    return np.nan_to_num(gain, nan=-np.inf, posinf=-np.inf)


@dataclass
class Growth:
    """Rules of one kind of tree."""

    depth: int
    ridge: float = 0.0
    min_gain: float = 0.0
    min_weight: float = 0.0  # of H in a child
    min_rows: float = 1.0  # in a child
    min_split: float = 2.0  # rows of a node that may be split
    tried: int | None = None  # random columns a node


def _best_splits(hist, numeric, outputs, rule: Growth, rng):
    """(total, best gain, column, bin) of every key; gain -inf where no split is allowed."""
    keys = len(hist[0][0])
    total = [s.sum(1) for s in hist[0]]
    left, column, where = _candidates(hist, numeric)
    if not len(column):
        return total, np.full(keys, -np.inf), np.zeros(keys, int), np.zeros(keys, int)
    gain = _gains(left, total, outputs, rule.ridge)
    hl, nl, h, n = left[outputs], left[-1], total[outputs][:, None], total[-1][:, None]
    bad = (nl < rule.min_rows) | (n - nl < rule.min_rows) | (hl < rule.min_weight) | (h - hl < rule.min_weight) | (n < rule.min_split)
    gain[bad] = -np.inf
    if rule.tried:
        # dummy columns are columns of their own: a numeric column's candidates share one draw
        group = np.where(np.array(numeric)[column], column, len(numeric) + np.arange(len(column)))
        names, slot = np.unique(group, return_inverse=True)
        usable = np.zeros((keys, len(names)), bool)
        for s in range(len(names)):
            usable[:, s] = ((nl[:, slot == s] > 0) & (n - nl[:, slot == s] > 0)).any(1)
        draw = np.where(usable, rng.random((keys, len(names))), 2.0)
        rank = draw.argsort(1).argsort(1)
        gain[(rank >= rule.tried)[:, slot]] = -np.inf
    best = gain.argmax(1)
    top = gain[np.arange(keys), best]
    top = np.where(top > max(rule.min_gain, 1e-12), top, -np.inf)
    return total, top, column[best], where[best]


def _goes_right(x: np.ndarray, numeric: np.ndarray, column: np.ndarray, where: np.ndarray) -> np.ndarray:
    v = x[np.arange(len(x)), column]
    return np.where(numeric[column], v > where, v == where)


def grow_levels(x, sizes, numeric, stats, outputs, rule: Growth, rng, after_level=None):
    """``grow_shared`` over cells that share nothing; ``stats``: arrays (trees, cells): outputs, then H, then rows."""
    return grow_shared(x, np.arange(len(x)), sizes, numeric, len(stats[0]), lambda t: [s[t] for s in stats], outputs, rule, rng, after_level)


def grow_shared(x, at, sizes, numeric, trees: int, stats_of, outputs, rule: Growth, rng, after_level=None):
    """Trees side by side, level by level.

    ``x``: combinations of bins, ``at``: the combination of every cell that has rows, ``stats_of(tree)``:
    arrays over these cells: outputs, then H, then rows.  Returns per level a dict of arrays over nodes
    (tree, heap number from 1, totals, gain, column, bin) and the final heap number of every (tree,
    combination); ``after_level(level, live, place, nodes)`` sees the trees as they stand when cut at that
    depth: the combinations of a tree that are in nodes of this level, and in which.
    """
    numeric = np.asarray(numeric, bool)
    final = np.ones((trees, len(x)), np.int64)
    live = np.ones((trees, len(x)), bool)
    place = np.repeat(np.arange(trees)[:, None], len(x), 1)
    tree, heap = np.arange(trees), np.ones(trees, np.int64)
    bins = [np.ascontiguousarray(x[:, f])[at] for f in range(x.shape[1])]
    levels = []
    for level in range(rule.depth + 1):
        if not live.any():
            break
        last, parts = level == rule.depth, []
        begin = np.searchsorted(tree, np.arange(trees + 1))
        for t in range(trees):
            if begin[t] == begin[t + 1]:
                continue
            stats, here = stats_of(t), live[t][at]
            own = slice(None) if here.all() else np.flatnonzero(here)
            taken = {id(s): s[own] for s in stats}
            used = bins[:1] if last else bins  # nodes of the last level only need their totals
            parts.append(_histograms([b[own] for b in used], sizes, place[t][at[own]] - begin[t], int(begin[t + 1] - begin[t]), [taken[id(s)] for s in stats]))
        hist = [[np.concatenate(s) for s in zip(*column)] for column in zip(*parts)]
        if last:
            total, gain = [s.sum(1) for s in hist[0]], np.full(len(tree), -np.inf)
            column = where = np.zeros(len(tree), int)
        else:
            total, gain, column, where = _best_splits(hist, numeric, outputs, rule, rng)
        nodes = {"tree": tree, "heap": heap, "total": total, "gain": gain, "column": column, "where": where}
        levels.append(nodes)
        if after_level:
            after_level(level, live, place, nodes)
        who, combination = np.nonzero(live)
        key = place[who, combination]
        go = np.isfinite(gain)[key]
        live[who, combination] = go
        who, combination, key = who[go], combination[go], key[go]
        child = 2 * key + _goes_right(x[combination], numeric, column[key], where[key])
        met = np.zeros(2 * len(tree), bool)
        met[child] = True
        names = np.flatnonzero(met)
        place[who, combination] = (np.cumsum(met) - 1)[child]
        tree, heap = tree[names >> 1], 2 * heap[names >> 1] + (names & 1)
        final[who, combination] = heap[place[who, combination]]
    return levels, final


def grow_leaves(x, sizes, numeric, stats, rule: Growth, leaves: int, rng, columns_used):
    """One tree, opening the leaf with the largest gain next.  Returns (nodes, leaf of every cell).

    ``stats``: arrays over cells: output, H, rows.  Nodes are dicts with parent links by position.
    """
    numeric = np.asarray(numeric, bool)
    kept = np.zeros(len(sizes), bool)
    kept[columns_used] = True
    used_sizes = np.where(kept, sizes, 1)  # a column with one bin offers no split
    masked = np.where(kept[None, :], x, 0)
    leaf = np.zeros(x.shape[0], np.int64)
    nodes: list[dict] = []

    def open_node(rows):
        sub = masked[rows]
        hist = _histograms([sub[:, f] for f in range(sub.shape[1])], used_sizes, np.zeros(len(rows), np.int64), 1, [s[rows] for s in stats])
        total, gain, column, where = _best_splits(hist, numeric, 1, rule, rng)
        nodes.append({"rows": rows, "total": [float(t[0]) for t in total], "gain": float(gain[0]), "column": int(column[0]),
                      "where": int(where[0]), "left": -1, "right": -1})
        leaf[rows] = len(nodes) - 1
        return len(nodes) - 1

    open_node(np.arange(x.shape[0]))
    for _ in range(leaves - 1):
        best = max((i for i, nd in enumerate(nodes) if nd["left"] < 0), key=lambda i: (nodes[i]["gain"], -i))
        nd = nodes[best]
        if not np.isfinite(nd["gain"]):
            break
        rows = nd["rows"]
        right = _goes_right(x[rows], numeric, np.full(len(rows), nd["column"]), np.full(len(rows), nd["where"]))
        nd["left"], nd["right"] = open_node(rows[~right]), open_node(rows[right])
        nd["rows"] = None
    return nodes, leaf


# ---------------------------------------------------------------- one (setting, fold)


class Report:
    """Collects node rows and held-out accuracies of one key."""

    def __init__(self, keep_nodes: bool):
        self.keep, self.nodes, self.scores = keep_nodes, [], []

    def level_nodes(self, tree_of, levels, value):
        if not self.keep:
            return
        for level in levels:
            v = value(level["total"])
            for i in range(len(level["heap"])):
                tree, split = tree_of(int(level["tree"][i])), bool(np.isfinite(level["gain"][i]))
                h = int(level["heap"][i])
                self.nodes.append((*tree, h, 2 * h if split else -1, 2 * h + 1 if split else -1, int(level["column"][i]) if split else -1,
                                   int(level["where"][i]) if split else -1, float(level["gain"][i]) if split else 0.0,
                                   float(level["total"][-1][i]), np.atleast_1d(v[..., i]).tolist()))

    def score(self, setting: dict, votes: np.ndarray, held: np.ndarray):
        """``votes`` and ``held``: (cells, classes)."""
        right = held[np.arange(len(held)), votes.argmax(1)].sum()
        self.scores.append((json.dumps(setting, sort_keys=True), int(right), int(held.sum())))


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(0))
    return e / e.sum(0)


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, number of the distinct row of each row)."""
    rows, at = np.unique(x, axis=0, return_inverse=True)
    return rows, at.ravel()


def fit_forest(x, at, sizes, numeric, fit, held, p: dict, report: Report) -> None:
    """``p``: trees, depths, min_split, min_leaf, balanced, seed; scores every prefix asked for.

    ``x``: combinations of bins, ``at``: that of every cell, ``fit``: (cells, classes), ``held``: (combinations, classes).
    """
    classes = fit.shape[1]
    n = int(fit.sum())
    per_class = fit.sum(0)
    weight = n / (np.count_nonzero(per_class) * np.maximum(per_class, 1)) if p["balanced"] else np.ones(classes)
    columns = int(sum(1 if o else b - 1 for b, o in zip(sizes, numeric)))
    rule = Growth(max(p["depths"]), min_rows=p["min_leaf"], min_split=p["min_split"], tried=max(1, int(np.sqrt(columns))))
    votes = {d: np.zeros((len(x), classes)) for d in p["depths"]}
    share = (fit / max(n, 1)).ravel()
    some = np.flatnonzero(fit.any(1))
    kind = np.int32 if n < 2**31 else np.int64
    for first in range(0, max(p["trees"]), TREES_TOGETHER):
        together = range(first, min(first + TREES_TOGETHER, max(p["trees"])))
        rng = np.random.default_rng([p["seed"], first])
        rows = [rng.multinomial(n, share).reshape(fit.shape)[some].astype(kind) for _ in together]  # bootstrap, by cell and label
        value = np.zeros((len(together), len(x), classes))

        def stats_of(t):
            g = rows[t] * weight
            return [*g.T, g.sum(1), rows[t].sum(1).astype(float)]

        def after_level(level, live, place, nodes):
            dist = np.stack(nodes["total"][:classes], 1)
            dist = dist / np.maximum(dist.sum(1, keepdims=True), 1e-300)
            value[live] = dist[place[live]]
            reached[0] = level
            if level in votes:
                votes[level] += value.sum(0)

        reached = [0]
        levels, _ = grow_shared(x, at[some], sizes, numeric, len(together), stats_of, classes, rule, rng, after_level)
        for d in votes:  # trees that ended early stay as they are
            if d > reached[0]:
                votes[d] += value.sum(0)
        report.level_nodes(lambda t: (first + t, -1), levels, lambda total: np.stack(total[:classes]) / np.maximum(sum(total[:classes]), 1e-300))
        done = first + len(together)
        if done in p["trees"]:
            for d in p["depths"]:
                report.score({"trees": done, "depth": d}, votes[d], held)


def fit_boosted(x, at, sizes, numeric, fit, held, p: dict, report: Report) -> None:
    """``p``: kind (gradient, newton, leafwise), rounds, rate and the kind's own rules; the rest as in ``fit_forest``."""
    kind, classes = p["kind"], fit.shape[1]
    if kind != "leafwise":  # opened leaf by leaf, a tree scores the cells that it is given
        some = np.flatnonzero(fit.any(1))
        at, fit = at[some], fit[some]
    rows = fit.sum(1).astype(float)
    n = rows.sum()
    prior = np.log(np.maximum(fit.sum(0) / max(n, 1), 1e-12))
    score = np.zeros((classes, len(x))) if kind == "newton" else np.repeat(prior[:, None], len(x), 1)
    curve = {"gradient": 1.0, "newton": 2.0, "leafwise": classes / max(classes - 1, 1)}[kind]
    ridge = p.get("ridge", 1.0 if kind == "newton" else 0.0)
    rule = Growth(p.get("depth", 0), ridge=ridge, min_gain=p.get("gamma", 0.0), min_weight=p.get("min_weight", 0.0), min_rows=p.get("min_rows", 1.0))
    if kind == "gradient":
        rule.min_weight = p["min_fraction"] * n
    rng = np.random.default_rng([p.get("seed", 42)])
    cell = x[at] if kind == "leafwise" else None
    if report.keep:  # the start score of each class is a tree of one leaf
        report.nodes += [(-1, k, 0, -1, -1, -1, -1, 0.0, n, [float(score[k, 0]) if len(x) else 0.0]) for k in range(classes)]
    for r in range(max(p["rounds"])):
        prob = _softmax(score)
        g = fit.T - rows * prob[:, at]  # residual sums
        h = np.maximum(curve * prob * (1 - prob), 1e-16)[:, at] * rows
        if kind == "leafwise":
            for k in range(classes):
                used = np.sort(rng.permutation(len(sizes))[:max(1, round(p["column_fraction"] * len(sizes)))])
                nodes, leaf = grow_leaves(cell, sizes, numeric, [g[k], h[k], rows], rule, p["leaves"], rng, used)
                value = np.array([p["rate"] * nd["total"][0] / (nd["total"][1] + ridge) if nd["total"][1] > 0 else 0.0 for nd in nodes])
                added = np.zeros(len(x))
                added[at] = value[leaf]
                score[k] += added
                if report.keep:
                    report.nodes += [(r, k, i, nd["left"], nd["right"], nd["column"] if nd["left"] >= 0 else -1, nd["where"] if nd["left"] >= 0 else -1,
                                      nd["gain"] if nd["left"] >= 0 else 0.0, nd["total"][2], [float(value[i])]) for i, nd in enumerate(nodes)]
        else:
            # first-order trees are split by residual variance (H is the number of rows) and get Newton leaves
            def stats_of(k):
                return [g[k], rows, h[k], rows] if kind == "gradient" else [g[k], h[k], h[k], rows]

            def leaf_value(total):
                with np.errstate(divide="ignore", invalid="ignore"):
                    v = (classes - 1) / classes * total[0] / total[2] if kind == "gradient" else total[0] / (total[2] + ridge)
                return p["rate"] * np.nan_to_num(v, nan=0.0, posinf=0.0, neginf=0.0)

            def after_level(level, live, place, nodes):
                v = np.where(np.isfinite(nodes["gain"]), 0.0, leaf_value(nodes["total"]))  # nodes that are split add nothing
                score[live] += v[place[live]]

            levels, _ = grow_shared(x, at, sizes, numeric, classes, stats_of, 1, rule, rng, after_level)
            report.level_nodes(lambda t: (r, t), levels, lambda total: leaf_value(total)[None, :])
        if r + 1 in p["rounds"]:
            report.score({"trees": r + 1}, score.T, held)


# ---------------------------------------------------------------- all keys at once


SCORES = "model int, setting string, correct long, held long"
NODES = "model int, tree int, class int, node long, left long, right long, column int, bin int, gain double, n_rows double, value array<double>"


def _packed(batches):
    """The cells of a batch as one compressed value: every model gets a copy of it."""
    for b in batches:
        if b.num_rows:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_batch(b)
            yield pa.RecordBatch.from_arrays([pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["packed"])


def _unpacked(packed: pa.ChunkedArray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, fold, rows per label) of all cells, ordered by fold and bins; bins in the least type that holds them."""
    parts, kind = [], np.min_scalar_type(int(sizes.max()))
    for v in packed:
        t = pa.ipc.open_stream(v.as_buffer()).read_all()
        x, w = (t.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1) for c in ("x", "w"))
        parts.append((x.astype(kind), t.column("fold").to_numpy(), w.astype(np.int64)))
    x, fold, w = (np.concatenate(p) for p in zip(*parts))
    order = np.lexsort([*x.T[::-1], fold])
    return x[order], fold[order], w[order]


def _fit_keys(cells_df: DataFrame, columns: Columns, models: list[dict], keep_nodes: bool) -> DataFrame:
    """One group a model: its cells in, its scores or nodes out.  ``models[i]``: rules, ``fold`` held out."""
    sizes, numeric = columns.sizes(), columns.numeric

    def fit(t: pa.Table) -> pa.Table:
        number = t.column("model")[0].as_py()
        p = models[number]
        cell, fold, w = _unpacked(t.column("packed"), sizes)
        x, at = _distinct(cell) if len(np.unique(fold)) > 1 else (cell, np.arange(len(cell)))
        out = fold == p["fold"]
        fit_rows = np.where(out[:, None], 0, w)
        held = np.stack([np.bincount(at[out], c, len(x)) for c in w[out].T], 1)
        report = Report(keep_nodes)
        (fit_forest if p["kind"] == "forest" else fit_boosted)(x, at, sizes, numeric, fit_rows, held, p, report)
        if keep_nodes:
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64())]
            data = list(zip(*report.nodes)) or [()] * len(kinds)
            arrays = [pa.array(np.full(len(report.nodes), number), pa.int32()), *[pa.array(list(c), k) for c, k in zip(data, kinds)]]
            names = [f.split(" ")[0] for f in NODES.split(", ")]
        else:
            data = list(zip(*report.scores)) or [()] * 3
            arrays = [pa.array([number] * len(report.scores), pa.int32()), pa.array(list(data[0]), pa.string()),
                      pa.array(list(data[1]), pa.int64()), pa.array(list(data[2]), pa.int64())]
            names = ["model", "setting", "correct", "held"]
        return pa.table(arrays, names=names)

    keyed = cells_df.select("x", "fold", "w").mapInArrow(_packed, "packed binary").withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(len(models) - 1))))
    return spread_groups(keyed, ["model"], len(models)).groupBy("model").applyInArrow(fit, NODES if keep_nodes else SCORES)


def written_cells(df: DataFrame, columns: Columns, label: str, classes: int, fold: str | None = None) -> DataFrame:
    """The cells, computed once into a table of the shared folder."""
    path = scratch_path(df.sparkSession, "cells")
    cells(df, columns, label, classes, fold).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def grid(family: str) -> list[dict]:
    """Settings of a family's search, in the order of their numbers."""
    def product(**values):
        return [dict(zip(values, v)) for v in itertools.product(*values.values())]

    if family == "random_forest":
        return product(trees=[50, 100], depth=[3, 5, 7], min_split=[2, 5], min_leaf=[1, 2], balanced=[True, False])
    if family == "gradient_boosting":
        return product(trees=[50, 100], rate=[0.01, 0.05, 0.1], depth=[3, 5, 7], min_fraction=[0.0, 0.01])
    if family == "newton_boosting":
        return product(trees=[50, 100], rate=[0.01, 0.05, 0.1], depth=[3, 5, 7])
    raise ValueError(f"unknown family: {family}")


def _fits(family: str, settings: list[dict]) -> list[tuple[dict, dict]]:
    """(rules of one fit, {scored prefix: number of the setting}) covering all settings with few fits."""
    shared = {"random_forest": ("trees", "depth"), "gradient_boosting": ("trees",), "newton_boosting": ("trees",)}[family]
    fits: dict[str, tuple[dict, dict]] = {}
    for number, s in enumerate(settings):
        own = {k: v for k, v in s.items() if k not in shared}
        rules, prefixes = fits.setdefault(json.dumps(own, sort_keys=True), (own, {}))
        prefixes[json.dumps({k: s[k] for k in shared}, sort_keys=True)] = number
    out = []
    for own, prefixes in fits.values():
        asked = [json.loads(k) for k in prefixes]
        trees = sorted({a["trees"] for a in asked})
        out.append((_rules(family, {**own, "depth": asked[0].get("depth", own.get("depth"))}, trees, sorted({a["depth"] for a in asked if "depth" in a})), prefixes))
    return out


def _rules(family: str, s: dict, trees: list[int], depths: list[int]) -> dict:
    if family == "random_forest":
        return {"kind": "forest", "trees": trees, "depths": depths, "min_split": s["min_split"], "min_leaf": s["min_leaf"], "balanced": s["balanced"], "seed": 42}
    if family == "gradient_boosting":
        return {"kind": "gradient", "rounds": trees, "rate": s["rate"], "depth": s["depth"], "min_fraction": s["min_fraction"]}
    return {"kind": "newton", "rounds": trees, "rate": s["rate"], "depth": s["depth"], "ridge": 1.0, "gamma": 0.0, "min_weight": 1.0}


def search(cells_df: DataFrame, columns: Columns, families: Sequence[str], folds: int = 5) -> DataFrame:
    """(family, setting, params, cv_accuracy): mean accuracy over the held-out folds of every setting.

    All families, settings and folds are fitted in one job.  Folds without rows do not count; without any
    cell there is no row.
    """
    models, names = [], []
    for family in families:
        settings = grid(family)
        for rules, prefixes in _fits(family, settings):
            for fold in range(folds):
                models.append({**rules, "fold": fold})
                names += [(len(models) - 1, prefix, family, number, json.dumps(settings[number], sort_keys=True)) for prefix, number in prefixes.items()]
    spark = cells_df.sparkSession
    known = spark.createDataFrame(names, "model int, setting string, family string, number int, params string")
    scored = _fit_keys(cells_df, columns, models, keep_nodes=False)
    return (scored.join(F.broadcast(known), ["model", "setting"])  # settings x folds rows
            .groupBy("family", F.col("number").alias("setting"), "params").agg(F.avg(F.try_divide("correct", "held")).alias("cv_accuracy")))


def best_settings(scores: DataFrame) -> DataFrame:
    """The setting with the largest accuracy of every family, ties to the smaller number."""
    w = Window.partitionBy("family").orderBy(F.desc("cv_accuracy"), "setting")
    return scores.withColumn("place", F.row_number().over(w)).where("place = 1").drop("place")


def fit_nodes(cells_df: DataFrame, columns: Columns, chosen: Sequence[tuple[str, dict]]) -> DataFrame:
    """Node tables of the given (family, setting) pairs, fitted on all cells; ``model`` is the pair's place."""
    models = [{**_rules(f, s, [s["trees"]], [s.get("depth")]), "fold": -2} for f, s in chosen]
    return _fit_keys(cells_df, columns, models, keep_nodes=True)


def fit_leafwise(cells_df: DataFrame, columns: Columns, rounds: int = 100, leaves: int = 31, rate: float = 0.05,
                 column_fraction: float = 0.9, min_rows: int = 20, min_hessian: float = 1e-3) -> DataFrame:
    """Node table of a leaf-wise boosted model over all cells."""
    p = {"kind": "leafwise", "rounds": [rounds], "rate": rate, "leaves": leaves, "column_fraction": column_fraction, "ridge": 0.0,
         "min_rows": float(min_rows), "min_weight": min_hessian, "fold": -2}
    return _fit_keys(cells_df, columns, [p], keep_nodes=True)


def with_names(nodes: DataFrame, columns: Columns) -> DataFrame:
    """Nodes with the column that each split tests: a numeric column's name, or ``column_level``."""
    rows = [(k, b, n if o else f"{n}_{c[b]}", float(c[b]) if o else None)
            for k, (n, o, c) in enumerate(zip(columns.names, columns.numeric, columns.cuts)) for b in range(len(c))]
    known = nodes.sparkSession.createDataFrame(rows, "column int, bin int, feature string, threshold double")
    return nodes.join(F.broadcast(known), ["column", "bin"], "left")  # bins of all columns


def split_counts(nodes: DataFrame, columns: Columns, top: int = 20) -> DataFrame:
    """(feature, splits): how many nodes test each feature, the ``top`` largest."""
    return (with_names(nodes, columns).where("left >= 0").groupBy("feature").agg(F.count("*").alias("splits"))
            .orderBy(F.desc("splits"), "feature").limit(top))


def predict(df: DataFrame, nodes: DataFrame, columns: Columns, model: int, out: str = "prediction") -> DataFrame:
    """``df`` with the predicted class; null where a column has no bin.

    Without nodes every prediction is null.  Only the node table of one model (trees x nodes a tree, bounded by its setting) goes to the tasks.
    Forests add class shares, boosted models add leaf values to class scores.
    """
    t = nodes.where(F.col("model") == model).orderBy("tree", "class", "node").select("tree", "class", "node", "left", "right", "column", "bin", "value").collect()
    if not t:
        return df.withColumn(out, F.lit(None).cast("double"))
    numeric = np.array(columns.numeric)
    starts: dict[tuple, int] = {}
    place = {(r["tree"], r["class"], r["node"]): i for i, r in enumerate(t)}
    for i, r in enumerate(t):
        starts.setdefault((r["tree"], r["class"]), i)
    left = np.array([place.get((r["tree"], r["class"], r["left"]), -1) for r in t], np.int64)
    right = np.array([place.get((r["tree"], r["class"], r["right"]), -1) for r in t], np.int64)
    column, where = np.array([max(r["column"], 0) for r in t]), np.array([r["bin"] for r in t])
    value = [r["value"] for r in t]
    classes = max(max((r["class"] for r in t), default=0) + 1, max((len(v) for v in value), default=1))
    table = np.zeros((len(t), classes))
    for i, r in enumerate(t):
        if r["class"] < 0:
            table[i] = r["value"]
        else:
            table[i, r["class"]] = r["value"][0]
    roots = list(starts.values())

    def classes_of(x):
        score = np.zeros((len(x), classes))
        for root in roots:
            at = np.full(len(x), root)
            while (inner := np.flatnonzero(left[at] >= 0)).size:
                a = at[inner]
                go = _goes_right(x[inner], numeric, column[a], where[a])
                at[inner] = np.where(go, right[a], left[a])
            score += table[at]
        return score.argmax(1)

    def run(batches):
        known: dict[bytes, int] = {}  # class by bins, of those met in this task
        for b in batches:
            rows = np.flatnonzero(b.column("__ok").to_numpy(zero_copy_only=False))
            label = np.zeros(b.num_rows, np.int64)
            if len(rows):
                x, place = _distinct(b.column("__x").take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1))
                if len(known) > REMEMBERED:
                    known = {}
                names_of = [v.tobytes() for v in x]
                new = [i for i, v in enumerate(names_of) if v not in known]
                if new:
                    known.update(zip([names_of[i] for i in new], classes_of(x[new]).tolist()))
                label[rows] = np.array([known[v] for v in names_of])[place]
            mask = np.ones(b.num_rows, bool)
            mask[rows] = False
            kept = [b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(label.astype(float), pa.float64(), mask=mask)], names=[*names, "__p"])

    names = [f"c{i}" for i in range(len(df.columns))]
    types = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, df.schema.fields))
    x = F.array(*[columns.bin_expr(k) for k in range(len(columns.names))])
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)], x.alias("__x"))
    rows = rows.withColumn("__ok", ~F.exists("__x", lambda v: v.isNull()))
    return rows.mapInArrow(run, f"{types}, __p double").toDF(*df.columns, out)
