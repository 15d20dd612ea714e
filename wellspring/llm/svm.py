"""A linear support vector machine on sparse rows, small enough to be fitted on the driver from a bounded sample."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

Row = tuple[np.ndarray, np.ndarray]  # distinct feature ids, values


def fit(rows: Sequence[Row], labels: Sequence[int], dim: int, epochs: int = 8, ridge: float = 1e-4, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias by stochastic subgradient steps on the hinge loss, averaged; classes weigh alike. Labels are 1, -1."""
    y = np.asarray(labels)
    share = {c: len(y) / max(1, 2 * int((y == c).sum())) for c in (1, -1)}
    # w = scale * v, so that shrinking costs nothing; the average is kept as a second weighted sum.
    v, total, bias, bias_sum, scale, t = np.zeros(dim), np.zeros(dim), 0.0, 0.0, 1.0, 0
    carried = 0.0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(y)):
            t += 1
            rate = 1.0 / (ridge * (t + 1 / ridge))
            ids, x = rows[i]
            margin = y[i] * (scale * float(v[ids] @ x) + bias)
            scale *= 1 - rate * ridge
            if margin < 1:
                step = rate * share[int(y[i])] * y[i]
                v[ids] += step / scale * x
                total[ids] -= carried * step / scale * x
                bias += 0.1 * step
            carried += scale
            bias_sum += bias
    return (total + carried * v) / max(1, t), bias_sum / max(1, t)


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 400, ridge: float = 1e-3) -> np.ndarray:
    """Coefficients (last: intercept) of a ridge logistic regression by Newton steps; y is 0 or 1."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(min(steps, 50)):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
