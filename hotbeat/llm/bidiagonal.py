"""Right singular vectors of the largest singular values of a small dense matrix.

Householder reflections reduce the matrix to an upper bidiagonal one; the differential quotient-difference
algorithm with shifts (dqds) finds its singular values to high relative accuracy, since it only adds,
multiplies and divides positive numbers; twisted factorisations of B'B - sigma^2 I give the vectors,
which the reflections carry back.  Work grows with the cube of the dimension, memory with its square.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(float).eps)
#: An off-diagonal entry below this share of its neighbourhood is zero (as LAPACK's dqds takes it).
NEGLIGIBLE = (100 * EPS) ** 2


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, superdiagonal, right reflectors) of an m x n matrix, padded with zero rows to m >= n."""
    m, n = r.shape
    a = np.zeros((max(m, n), n))
    a[:m] = r
    reflectors = []

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        """(v, alpha): (I - 2 v v') x = alpha e1 with |v| = 1, or v = 0 where x has that form already."""
        scale = np.abs(x).max() if len(x) else 0.0
        if scale == 0 or not np.abs(x[1:]).max(initial=0.0):
            return np.zeros(len(x)), float(x[0]) if len(x) else 0.0
        y = x / scale
        alpha = -math.copysign(math.sqrt(float(y @ y)), y[0])
        v = y.copy()
        v[0] -= alpha
        return v / math.sqrt(float(v @ v)), alpha * scale

    diagonal, above = np.zeros(n), np.zeros(max(0, n - 1))
    for k in range(n):
        v, diagonal[k] = reflector(a[k:, k])
        if k + 1 < n:
            rest = a[k:, k + 1:]
            rest -= np.outer(2 * v, v @ rest)
            w, above[k] = reflector(a[k, k + 1:])
            below = a[k + 1:, k + 1:]
            below -= np.outer(below @ w, 2 * w)
            reflectors.append(w)
    return diagonal, above, reflectors


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], int]:
    """One transform with a shift: new arrays, and the place where it failed (-1: nowhere)."""
    d = q[0] - shift
    new_q, new_e = [0.0] * len(q), [0.0] * len(e)
    for k, ek in enumerate(e):
        if not d >= 0:
            return new_q, new_e, k
        total = d + ek
        if total == 0:
            return new_q, new_e, k
        ratio = q[k + 1] / total
        new_q[k], new_e[k] = total, ek * ratio
        d = d * ratio - shift
    new_q[-1] = d
    return new_q, new_e, -1 if d >= 0 else len(q) - 1


def _lower_bound(q: list[float], e: list[float]) -> tuple[float, float]:
    """(sure lower bound, upper bound) of the smallest eigenvalue, from a transform without a shift.

    The reciprocals of its d values are the diagonal of the inverse: their sum bounds the inverse's
    largest eigenvalue from above, their maximum from below.
    """
    d, total, least = q[0], 0.0, math.inf
    for k in range(len(q)):
        if d <= 0:
            return 0.0, 0.0
        total += 1 / d
        least = min(least, d)
        if k < len(e):
            d *= q[k + 1] / (d + e[k])
    return (1 / total if math.isfinite(total) else 0.0), least


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, largest first, by dqds."""
    if not len(diagonal):
        return np.zeros(0)
    top = max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))
    if top == 0:
        return np.zeros(len(diagonal))
    unit = 2.0 ** math.floor(math.log2(top))  # exact scaling keeps squares in range
    found: list[float] = []
    blocks = [(((diagonal / unit) ** 2).tolist(), ((above / unit) ** 2).tolist(), 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        while q:
            # split where a coupling is negligible; the last part is worked on first
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= NEGLIGIBLE * (sigma + min(q[k], q[k + 1]))
                        or e[k] <= EPS * EPS * sigma), None)
            if cut is not None:
                blocks.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
            if len(q) == 1:
                found.append(sigma + q[0])
                break
            if cut is not None:
                continue
            if q[0] * 1.5 < q[-1]:  # graded the other way: the reversed arrays have the same values
                q, e = q[::-1], e[::-1]
            sure, most = _lower_bound(q, e)
            # the smaller eigenvalue of the last 2 x 2 block is near the smallest of all, yet no sure bound
            half, product = (q[-2] + e[-1] + q[-1]) / 2, q[-2] * q[-1]
            guess = product / (half + math.sqrt(max(0.0, half * half - product))) if half > 0 else 0.0
            shift = max(sure, min(guess, most) * (1 - 1e-3) if guess > most * 0.5 else min(guess, most))
            for trial in (shift, max(sure, shift / 2), sure * (1 - 4 * EPS * len(q)), 0.0):
                new_q, new_e, failed = _dqds(q, e, trial)
                if failed < 0:
                    q, e, sigma = new_q, new_e, sigma + trial
                    break
            else:  # a zero on the diagonal: the transform without a shift stops there and splits
                k = failed
                new_q[k + 1:], new_e[k:] = q[k + 1:], e[k:]
                if k < len(e):
                    # d and e are both zero: rows up to k stand alone
                    new_q[k], new_e[k] = 0.0, 0.0
                else:
                    new_q[k] = 0.0
                q, e = new_q, new_e
    return np.sort(np.array(found))[::-1] * unit * unit


def _twisted(b: np.ndarray, f: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gamma, lower multipliers, upper multipliers) of B'B - value I, twisted at every place."""
    n = len(b)
    tiny = EPS * EPS * max(value, float(np.finfo(float).tiny))
    lower, upper = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for k in range(n - 1):  # stationary, from the top
        pivot = s[k] + b[k] * b[k] or tiny
        lower[k] = b[k] * f[k] / pivot
        s[k + 1] = f[k] * f[k] * (s[k] / pivot) - value
    p[n - 1] = b[n - 1] * b[n - 1] - value
    for k in range(n - 2, -1, -1):  # progressive, from the bottom
        pivot = f[k] * f[k] + p[k + 1] or tiny
        upper[k] = b[k] * f[k] / pivot
        p[k] = p[k + 1] * (b[k] * b[k] / pivot) - value
    return s + p + value, lower, upper


def _vector(lower: np.ndarray, upper: np.ndarray, twist: int) -> np.ndarray:
    z = np.zeros(len(lower) + 1)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -lower[k] * z[k + 1]
    for k in range(twist, len(lower)):
        z[k + 1] = -upper[k] * z[k]
    return z / np.linalg.norm(z)


def bidiagonal_vectors(b: np.ndarray, f: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the ``count`` largest squared singular values and their right vectors (rows).

    Blocks between negligible couplings are solved apart, so that equal values of different blocks have
    vectors with disjoint supports; within a block, vectors of close values are made orthogonal to each
    other, from another twist where too little of one is left.
    """
    n = len(b)
    limit = EPS * max(np.abs(b).max(initial=0.0), np.abs(f).max(initial=0.0))
    cuts = [0, *(np.flatnonzero(np.abs(f) <= limit * EPS) + 1).tolist(), n]
    pairs = []  # (value, start, end)
    for lo, hi in zip(cuts, cuts[1:]):
        for v in squared_singular_values(b[lo:hi], f[lo:hi - 1])[:count]:
            pairs.append((float(v), lo, hi))
    pairs.sort(key=lambda x: (-x[0], x[1]))
    values, vectors = [], []
    for value, lo, hi in pairs[:count]:
        z = np.zeros(n)
        if hi - lo == 1 or value == 0:
            z[lo] = 1.0
        else:
            unit = math.sqrt(value)
            gamma, lower, upper = _twisted(b[lo:hi] / unit, f[lo:hi - 1] / unit, 1.0)
            size = np.where(np.isfinite(gamma), np.abs(gamma), np.inf)
            near = [v for w, v in zip(values, vectors) if abs(w - value) <= 1e-3 * w]
            best, most = None, -1.0
            for twist in np.argsort(size, kind="stable")[:len(near) + 4].tolist():
                z[lo:hi] = _vector(lower, upper, twist)
                left = z.copy()
                for _ in range(2):
                    for v in near:
                        left = left - (v @ left) * v
                norm = float(np.linalg.norm(left))
                if norm > most:
                    best, most = left / norm if norm > 0 else left, norm
                if norm > 0.7:
                    break
            z = best
        values.append(value)
        vectors.append(z)
    return np.array(values), np.array(vectors).reshape(-1, n)


def leading_directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, unit right singular vectors as rows) of the ``count`` largest of a matrix.

    A value that rounding alone can explain is zero, and so is its vector.
    """
    b, f, reflectors = bidiagonalise(r)
    values, z = bidiagonal_vectors(b, f, min(count, r.shape[1]))
    if len(values):
        none = values <= (max(r.shape) * EPS) ** 2 * values[0]
        values, z = np.where(none, 0.0, values), np.where(none[:, None], 0.0, z)
    z = z.T.copy()
    for k in range(len(reflectors) - 1, -1, -1):
        w = reflectors[k]
        z[k + 1:] -= np.outer(2 * w, w @ z[k + 1:])
    return values, z.T
