"""Whitening of embeddings by blockwise QR and a bidiagonal qd solver.

Components become whole numbers; every distinct vector is fitted once.  Tasks reduce the centred rows
of their partition block by block to one triangular factor R, and the factors are merged sixteen at a
time until one is left (R'R is n times the covariance, but no product of data with itself is formed).
R has the vectors' dimension, whatever the number of rows; ``bidiagonal`` finds its leading singular
values and directions in one task.  Vectors of different lengths are fitted apart, each length for itself.

Sums over rows are exact integers; centred values are exact before they are rounded once.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat.llm.bidiagonal import leading_directions
from hotbeat.llm.common import written

#: Components are floor(SCALE * c).
SCALE = 256.0
#: Rows that are reduced by one QR step, and triangular factors that are merged by one task.
BLOCK_ROWS = 4096
FAN_IN = 16
#: Numbers of open factors or sums that a task holds before it hands them on.
HELD_NUMBERS = 16_000_000
LONG = 2**63 - 1


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, x) with x = floor(256 * c) of every component; rows with a null vector or a null or
    non-finite component are left out, and so are empty vectors.  Values beyond 64 bits stop at the limit."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    scaled = F.transform(F.col("v"), lambda c: F.floor(F.lit(SCALE) * c.cast("double")))
    return (vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
            .where((F.size("v") > 0) & ~F.exists("v", bad)).select("id", scaled.alias("x")))


def _matrices(batch: pa.RecordBatch):
    """(row numbers, matrix) of every vector length of a batch with column x."""
    x = batch.column("x")
    offsets = np.asarray(x.offsets)
    flat = x.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        if len(rows) == len(sizes):
            yield rows, flat[offsets[0]:offsets[-1]].reshape(-1, d)
        else:
            yield rows, flat[offsets[rows][:, None] + np.arange(d)]


def _peak(m: np.ndarray) -> int:
    return max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))


def _times_less(m: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n * m - s, exactly: 64-bit where that is enough, else whole numbers of any size."""
    if _peak(m) * n + max(map(abs, s)) <= LONG:
        return m * n - np.array(s, np.int64)
    return m.astype(object) * n - np.array(s, object)


def _centred(m: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    return (_times_less(m, n, s) / n).astype(np.float64)


def _deviation(m: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """Sums of squares of n * m - s; None beyond 64 bits."""
    c = _times_less(m, n, s)
    if c.dtype != object and _peak(c) ** 2 * c.shape[1] <= LONG:
        return (c * c).sum(1).tolist()
    return [v if v <= LONG else None for v in (sum(int(a) ** 2 for a in row) for row in c)]


def _sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """{vector length: (n, exact sums by dimension)}; the driver holds one row a length."""
    def run(batches):
        held: dict[int, list] = {}

        def flush():
            d = list(held)
            out = pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int32()), pa.array([held[k][0] for k in d], pa.int64()),
                 pa.array([[Decimal(v) for v in held[k][1]] for k in d], pa.list_(pa.decimal128(38, 0)))], names=["d", "n", "s"])
            held.clear()
            return out

        for b in batches:
            for _, m in _matrices(b):
                total = m.sum(0).tolist() if _peak(m) * len(m) <= LONG else m.astype(object).sum(0).tolist()
                n, s = held.get(m.shape[1], (0, [0] * m.shape[1]))
                held[m.shape[1]] = (n + len(m), [a + c for a, c in zip(s, total)])
            if sum(held) > HELD_NUMBERS:
                yield flush()
        if held:
            yield flush()

    parts = fit.mapInArrow(run, "d int, n long, s array<decimal(38,0)>")
    by_place = (parts.select("d", "n", F.posexplode("s").alias("place", "s")).groupBy("d", "place")
                .agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    rows = (by_place.groupBy("d").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "s"))).alias("s"))
            .select("d", "n", "s.s").collect())
    return {r["d"]: (r["n"], [int(v) for v in r["s"]]) for r in rows}


_FACTOR = "d int, slot long, r array<double>"


def _factor_batch(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([d for d, _, _ in rows], pa.int32()), pa.array([slot for _, slot, _ in rows], pa.int64()),
         pa.array([r.ravel() for _, _, r in rows], pa.list_(pa.float64()))], names=["d", "slot", "r"])


def triangular_factors(fit: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> DataFrame:
    """(d, slot, r): for every vector length one triangular factor of all centred rows."""
    def reduce_blocks(batches):
        slot = TaskContext.get().partitionId()
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for _, m in _matrices(b):
                d = m.shape[1]
                for a in range(0, len(m), BLOCK_ROWS):
                    block = _centred(m[a:a + BLOCK_ROWS], *sums[d])
                    r = held.get(d)
                    held[d] = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
            if sum(r.size for r in held.values()) > HELD_NUMBERS:
                for d, r in held.items():
                    yield _factor_batch([(d, slot, r)])
                held.clear()
        for d, r in held.items():
            yield _factor_batch([(d, slot, r)])

    def merge(t: pa.Table) -> pa.Table:
        d, slot = t.column("d")[0].as_py(), t.column("slot")[0].as_py()
        r = None
        for v in t.column("r"):  # one after the other: a task holds two factors
            part = v.values.to_numpy(zero_copy_only=False).reshape(-1, d)
            r = part if r is None else np.linalg.qr(np.vstack([r, part]), mode="r")
        return pa.Table.from_batches([_factor_batch([(d, slot, r)])])

    slots = max(1, fit.rdd.getNumPartitions())
    factors = fit.mapInArrow(reduce_blocks, _FACTOR)
    while slots > 1:
        slots = -(-slots // FAN_IN)
        factors = factors.withColumn("slot", F.pmod("slot", F.lit(slots))).groupBy("d", "slot").applyInArrow(merge, _FACTOR)
    return factors


def fit_directions(fit: DataFrame, sums: dict[int, tuple[int, list[int]]], components: int) -> dict[int, dict]:
    """{vector length: n, s, eigenvalues, directions (rows), trace}: a few vectors of that length each."""
    def solve(t: pa.Table) -> pa.Table:
        d = t.column("d")[0].as_py()
        r = np.vstack([v.values.to_numpy(zero_copy_only=False).reshape(-1, d) for v in t.column("r")])
        n = sums[d][0]
        values, z = leading_directions(r, components)
        # the columns' norms keep their sum of squares under the factorisation: n times the trace
        trace = float(np.square(r).sum()) / n
        return pa.table({"d": pa.array([d], pa.int32()), "e": pa.array([(values / n).tolist()], pa.list_(pa.float64())),
                         "z": pa.array([z.ravel()], pa.list_(pa.float64())), "trace": pa.array([trace], pa.float64())})

    solved = triangular_factors(fit, sums).groupBy("d").applyInArrow(solve, "d int, e array<double>, z array<double>, trace double")
    return {r["d"]: {"n": sums[r["d"]][0], "s": sums[r["d"]][1], "e": np.array(r["e"]),
                     "z": np.array(r["z"]).reshape(len(r["e"]), -1), "trace": r["trace"]} for r in solved.collect()}


def _project(m: np.ndarray, model: dict) -> np.ndarray:
    """Whitened coordinates of the components with variance."""
    live = model["e"] > 0
    return _centred(m, model["n"], model["s"]) @ (model["z"][live] / np.sqrt(model["e"][live])[:, None]).T


def identity_errors(fit: DataFrame, models: dict[int, dict]) -> dict[int, float | None]:
    """{vector length: largest absolute entry of the whitened fit rows' covariance minus the identity}.

    Whitened rows are centred as they come (the mean is taken off before the projection).
    """
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for _, m in _matrices(b):
                d = m.shape[1]
                for a in range(0, len(m), BLOCK_ROWS):
                    w = _project(m[a:a + BLOCK_ROWS], models[d])
                    held[d] = held.get(d, 0.0) + w.T @ w
        for d, g in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([g.ravel()], pa.list_(pa.float64()))], names=["d", "g"])

    by_place = (fit.mapInArrow(run, "d int, g array<double>").select("d", F.posexplode("g").alias("place", "g"))
                .groupBy("d", "place").agg(F.sum("g").alias("g")))
    out: dict[int, float | None] = dict.fromkeys(models)
    for r in by_place.collect():
        model = models[r["d"]]
        k = int((model["e"] > 0).sum())
        off = abs(r["g"] / model["n"] - (r["place"] // k == r["place"] % k))
        out[r["d"]] = max(out[r["d"]] or 0.0, off)
    return out


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error) of every row and component.

    Components are numbered from 1 by falling eigenvalue; a vector has no more of them than its length.
    Repeated rows and null ids stay; other columns are ignored; an empty table, or one whose rows all
    drop out, gives an empty table.  A component without variance (one distinct vector, a rank below the
    number of components) has a null ``whitened``, ``explained`` 0 (null if nothing varies at all) and no
    part in ``identity_error``, which is null if no component is left.  ``deviation`` is null beyond 64 bits.

    The distinct vectors are written once to the shared folder; the driver holds per vector length the
    sums and ``components`` directions, a few vectors, and sends them to the tasks.
    """
    rows = whole_vectors(vectors, id_col, vec_col)
    fit = written(rows.select("x").distinct(), "whitening-fit")
    sums = _sums(fit)
    models = fit_directions(fit, sums, components) if sums else {}
    errors = identity_errors(fit, models) if models else {}
    kind = vectors.schema[id_col].dataType.simpleString()
    names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        for b in batches:
            for which, m in _matrices(b):
                d = m.shape[1]
                model = models[d]
                k, live = len(model["e"]), model["e"] > 0
                for a in range(0, len(m), BLOCK_ROWS):
                    part, ids = m[a:a + BLOCK_ROWS], b.column("id").take(pa.array(np.repeat(which[a:a + BLOCK_ROWS], k)))
                    r = len(part)
                    w = np.zeros((r, k))
                    w[:, live] = _project(part, model)
                    explained = model["e"] / model["trace"] if model["trace"] > 0 else np.zeros(k)
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(np.tile(np.arange(1, k + 1), r), pa.int32()), pa.array(np.full(r * k, model["n"]), pa.int64()),
                         pa.array([v for v in _deviation(part, model["n"], model["s"]) for _ in range(k)], pa.int64()),
                         pa.array(w.ravel(), pa.float64(), mask=np.tile(~live, r)),
                         pa.array(np.tile(explained, r), pa.float64(), mask=np.full(r * k, not model["trace"] > 0)),
                         pa.array([errors[d]] * (r * k), pa.float64())], names=names)

    out = rows.mapInArrow(run, f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out.withColumnRenamed("id", id_col)
