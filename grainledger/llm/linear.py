"""Linear models over sparse rows, small enough for one process: the rows are a bounded sample."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np


@dataclass
class Rows:
    """Sparse rows: row i holds columns[start[i]:start[i+1]] with the given values."""

    start: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, columns: list[np.ndarray], values: Iterable[np.ndarray] | None = None) -> Rows:
        """Columns keep their type of integer; values are taken row by row, so that they are never there twice."""
        start = np.concatenate([[0], np.cumsum([len(c) for c in columns])]).astype(np.int64)
        flat = np.concatenate(columns) if columns else np.zeros(0, np.int64)
        own = np.ones(len(flat))
        for at, row in zip(start.tolist(), values or ()):
            own[at : at + len(row)] = row
        return cls(start, flat, own)

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> Rows:
        parts = [np.arange(self.start[i], self.start[i + 1]) for i in rows.tolist()]
        at = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        start = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return Rows(start, self.columns[at], self.values[at])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.values * weights[self.columns])])
        return sums[self.start[1:]] - sums[self.start[:-1]]


def hinge_by_dual_descent(
    rows: Rows, signs: np.ndarray, cost: np.ndarray, width: int, rounds: int = 20, seed: int = 1
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised L2-loss linear SVM, by dual coordinate descent.

    One dual variable a row; each step solves for one of them exactly and keeps the weights up to date. The bias is
    one more feature with value 1. `cost` is the penalty of each row's loss.
    """
    weights, bias = np.zeros(width), 0.0
    alpha = np.zeros(len(rows))
    ridge = 1 / (2 * cost)
    norm = np.array([(rows.values[a:b] ** 2).sum() for a, b in zip(rows.start[:-1], rows.start[1:])]) + 1 + ridge
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        largest = 0.0
        for i in rng.permutation(len(rows)).tolist():
            own = slice(rows.start[i], rows.start[i + 1])
            columns, values = rows.columns[own], rows.values[own]
            slope = signs[i] * (weights[columns] @ values + bias) - 1 + ridge[i] * alpha[i]
            if alpha[i] == 0 and slope >= 0:
                continue
            largest = max(largest, abs(slope))
            now = max(alpha[i] - slope / norm[i], 0.0)
            step = (now - alpha[i]) * signs[i]
            if step:
                weights[columns] += step * values
                bias += step
                alpha[i] = now
        if largest < 0.01:
            break
    return weights, bias


def logistic(
    rows: Rows, truth: np.ndarray, weight: np.ndarray, width: int, l2: float = 1e-3, rounds: int = 60
) -> tuple[np.ndarray, float]:
    """Weights and bias of L2-regularised logistic regression, by limited-memory BFGS. The bias is not penalised."""
    weight = weight / weight.sum()
    owner = np.repeat(np.arange(len(rows)), np.diff(rows.start))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        margin = rows.dot(x[:width]) + x[width]
        signed = np.where(truth == 1, margin, -margin)
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - truth) * weight
        slope = np.append(np.bincount(rows.columns, error[owner] * rows.values, width) + l2 * x[:width], error.sum())
        return float(weight @ np.logaddexp(0, -signed) + l2 / 2 * (x[:width] @ x[:width])), slope

    x = np.zeros(width + 1)
    value, slope = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        if np.abs(slope).max() < 1e-6:
            break
        way, kept = slope.copy(), []
        for s, y in reversed(steps):
            a = (s @ way) / (s @ y)
            way -= a * y
            kept.append(a)
        if steps:
            s, y = steps[-1]
            way *= (s @ y) / (y @ y)
        for (s, y), a in zip(steps, reversed(kept)):
            way += (a - (y @ way) / (s @ y)) * s
        size = 1.0 if steps else 1.0 / max(np.abs(slope).sum(), 1.0)
        while size > 1e-10:
            there = x - size * way
            new, new_slope = loss(there)
            if new <= value - 1e-4 * size * (slope @ way):
                break
            size /= 2
        else:
            break
        s, y = there - x, new_slope - slope
        if s @ y > 1e-12:
            steps = [*steps[-9:], (s, y)]
        x, value, slope = there, new, new_slope
    return x[:width], float(x[width])
