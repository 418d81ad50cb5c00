"""Logistic regression on a bounded sample, for calibrating scores."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, scale, weights with the intercept last) by Newton's method."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    a = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) + penalty * w
        hessian = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def logistic(x: np.ndarray, model) -> np.ndarray:
    mean, scale, w = model
    return 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -30, 30)))
