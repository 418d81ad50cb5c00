"""Nearest neighbours by inner product: block matrix join on int8 products.

Within a cell every vector is held as int8 components and one scale.  A tile of queries and a tile of
candidates are multiplied as small integers, which gives every product with a known error bound:
|x.y - x'.y'| <= |x'| |y - y'| + |x - x'| |y|.  Pairs whose upper bound reaches the k-th best lower
bound (or the k-th exact score found so far) are computed again from the original components in
double precision, and heaps of k keep each query's best.  The bounds are sound, so the result is
that of an exhaustive search.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hotbeat.llm.cells import finite_vectors, search_cells

QUERY_TILE = 256
CANDIDATE_TILE = 2048


def quantised(v: np.ndarray):
    """(int8 components as float32, scale, norm of the held vector, norm of the error)."""
    scale = np.abs(v).max(1) / 127.0
    scale[scale == 0] = 1.0
    small = np.rint(v / scale[:, None]).astype(np.int8)
    held = small * scale[:, None]
    return small.astype(np.float32), scale, np.sqrt((held**2).sum(1)), np.sqrt(((v - held) ** 2).sum(1))


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in the order of the dimensions."""
    total = np.zeros(len(q))
    for d in range(q.shape[1]):
        total += q[:, d] * c[:, d]
    return total


def int8_cell(candidates, queries, k: int):
    """The k nearest candidates of each query within one cell."""
    c_row, c_id, c = candidates
    q_row, q_id, q = queries
    c, q = c.astype(np.float64), q.astype(np.float64)
    wide = np.float32 if c.shape[1] <= 1024 else np.float64  # holds the integer sums exactly
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(len(q))]
    with np.errstate(over="ignore", invalid="ignore"):
        c8, c_scale, c_held, c_err = quantised(c)
        q8, q_scale, q_held, q_err = quantised(q)
        c_norm = np.sqrt((c**2).sum(1))
        for a in range(0, len(c), CANDIDATE_TILE):
            cs = slice(a, a + CANDIDATE_TILE)
            for b in range(0, len(q), QUERY_TILE):
                qs = slice(b, b + QUERY_TILE)
                product = (q8[qs].astype(wide) @ c8[cs].astype(wide).T).astype(np.float64) * q_scale[qs, None] * c_scale[None, cs]
                bound = (q_held[qs, None] * c_err[None, cs] + q_err[qs, None] * c_norm[None, cs]) * (1 + 1e-9) + 1e-300
                upper = np.nan_to_num(product + bound, nan=np.inf, posinf=np.inf, neginf=-np.inf)
                lower = np.nan_to_num(product - bound, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                own = q_row[qs, None] == c_row[None, cs]
                upper[own], lower[own] = -np.inf, -np.inf
                least = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[qs]])
                if lower.shape[1] > k:
                    least = np.maximum(least, np.partition(lower, lower.shape[1] - k, axis=1)[:, lower.shape[1] - k])
                qi, ci = np.nonzero((upper >= least[:, None]) & ~own)
                qi, ci = qi + b, ci + a
                for n, i, s in zip(qi.tolist(), c_id[ci].tolist(), _exact(q[qi], c[ci]).tolist()):
                    h, entry = heaps[n], (s, -i)
                    if len(h) < k:
                        heapq.heappush(h, entry)
                    elif entry > h[0]:
                        heapq.heapreplace(h, entry)
    found = [(n, -i, s) for n, h in enumerate(heaps) for s, i in h]
    at = np.array([n for n, _, _ in found], np.int64)
    return [q_row[at], q_id[at], np.array([i for _, i, _ in found], np.int64), np.array([s for _, _, s in found], np.float64)]


def nearest(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k largest inner products among the other rows.

    ``is_query`` is a condition on the column ``id``.  Rows with a null id, a null, empty or zero
    vector, or a component that is null or not finite take no part; vectors are compared with those
    of their length only.  Repeated rows are rows of their own; ties go to the smaller id.
    """
    rows = finite_vectors(vectors, id_col, vec_col).where(F.exists("v", lambda x: x != 0))
    return search_cells(rows, is_query, int8_cell, k)
