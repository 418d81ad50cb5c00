"""Exact top-k search by inner product: columnar branch and bound.

Vectors lie dimension by dimension (vertical layout).  For a query the scores of all candidates of a
cell are accumulated one block of dimensions at a time, the blocks with most mass first; what the
remaining blocks can still add is at most the sum of their products of norms (Cauchy-Schwarz).  After
the first block the most promising candidates are scored whole: their k-th best score is a floor from then
on.  A candidate whose upper bound lies below the floor is dropped, and the survivors' columns are
compacted before the next block.  Components are integers, floor(1024 * x), so sums and comparisons are exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from hotbeat.llm.cells import finite_vectors, search_cells

SCALE = 1024.0
#: Dimensions accumulated between two prunings.
BLOCK = 8
#: Below this, float arithmetic on integers is exact.
EXACT = 2.0**52


def _scaled(v: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(v.astype(np.float64) * SCALE)


def _slow_scores(cand: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of very large components, by whole numbers of any size, held to 64 bits."""
    q = [int(x) for x in query]
    limit = 2**63 - 1
    return np.array([max(-limit, min(limit, sum(a * int(b) for a, b in zip(q, row)))) for row in cand], np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _scan(columns: np.ndarray, mass: np.ndarray, q: np.ndarray, alive: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(candidates, scores, candidates left before every block): all that may be among the k best.

    ``columns``: dimensions x candidates; ``mass``: norms by block and candidate; ``alive``: the candidates
    to look at, None for all.
    """
    dims, n = columns.shape
    cuts = [*range(0, dims, BLOCK), dims]
    weight = np.array([np.sqrt((q[lo:hi] ** 2).sum()) for lo, hi in zip(cuts, cuts[1:])])
    order = np.argsort(-weight * mass.mean(1), kind="stable")
    rest = np.zeros((len(order) + 1, n))
    for t in range(len(order) - 1, 0, -1):
        rest[t] = rest[t + 1] + weight[order[t]] * mass[order[t]]
    whole = alive is None
    alive = np.arange(n) if whole else alive
    total, floor, left = np.zeros(len(alive)), -np.inf, []
    for t, b in enumerate(order.tolist()):
        left.append(len(alive))
        block = columns[cuts[b]:cuts[b + 1]]
        total = total + q[cuts[b]:cuts[b + 1]] @ (block if whole else block[:, alive])
        if t + 1 < len(order) and len(alive) > k:
            # a little more than the bound, against rounding of the norms
            may = (rest[t + 1] if whole else rest[t + 1][alive]) * (1 + 1e-9) + 1e-6
            if t == 0:
                m = min(len(alive), 2 * k)
                likely = alive[np.argpartition(total + may, len(alive) - m)[len(alive) - m:]]
                floor = np.partition(q @ columns[:, likely], m - k)[m - k]
            floor = max(floor, np.partition(total - may, len(alive) - k)[len(alive) - k])
            keep = total + may >= floor
            if keep.mean() < 0.9:
                alive, total, whole = alive[keep], total[keep], False
    return alive, total, left


def _block_mass(columns: np.ndarray) -> np.ndarray:
    return np.array([np.sqrt((columns[lo:lo + BLOCK] ** 2).sum(0)) for lo in range(0, len(columns), BLOCK)])


def exact_cell(candidates, queries, k: int):
    """The k best candidates of each query within one cell."""
    c_row, c_id, c = candidates
    q_row, q_id, q = queries
    c, q = _scaled(c), _scaled(q)
    c_ok, q_ok = np.isfinite(c).all(1), np.isfinite(q).all(1)
    c_row, c_id, c, q_row, q_id, q = c_row[c_ok], c_id[c_ok], c[c_ok], q_row[q_ok], q_id[q_ok], q[q_ok]
    out: list[list[np.ndarray]] = [[], [], [], []]
    if not len(c) or not len(q):
        return [np.zeros(0, np.int64)] * 4
    columns = np.ascontiguousarray(c.T)
    with np.errstate(over="ignore"):
        mass = _block_mass(columns)
        longest, norms = np.sqrt((columns ** 2).sum(0)).max(), np.sqrt((q ** 2).sum(1))
    for n in range(len(q)):
        own = c_row == q_row[n]
        if norms[n] * longest < EXACT:
            alive, total, _ = _scan(columns, mass, q[n], np.flatnonzero(~own) if own.any() else None, k)
            scores = total.astype(np.int64)
        else:
            alive = np.flatnonzero(~own)
            scores = _slow_scores(c[alive], q[n])
        top = _best(scores, c_id[alive], k)
        for column, x in zip(out, (np.full(len(top), q_row[n]), np.full(len(top), q_id[n]), c_id[alive][top], scores[top])):
            column.append(x)
    return [np.concatenate(x) for x in out]


def top_k_inner_products(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id",
                         vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best other rows, ties to the smaller id.

    ``is_query`` is a condition on the column ``id``.  Rows with a null id, a null or empty vector or
    a component that is null or not finite take no part; vectors are compared with those of their
    length only.  Repeated rows are rows of their own.  Scores beyond 64 bits are held at the limit.
    """
    return search_cells(finite_vectors(vectors, id_col, vec_col), is_query, exact_cell, k)
