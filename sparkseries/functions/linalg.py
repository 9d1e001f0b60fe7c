"""Small dense solves on centred sums of products. Everything here is d x d, never a series.

Moments are kept as (row count, means, sums of products around the means) of the columns
x1..xd, y. Nothing is subtracted from a raw sum of squares, so a series far from zero loses no
digits; parts of a series are combined by the pairwise formula.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Moments(NamedTuple):
    n: float
    mean: np.ndarray
    centred: np.ndarray


def empty(d: int) -> Moments:
    return Moments(0.0, np.zeros(d + 1), np.zeros((d + 1, d + 1)))


def unpack(packed, d: int) -> Moments:
    """From [n, means, row-wise upper triangle of the centred sums]."""
    flat = np.asarray(packed, dtype=float)
    full = np.zeros((d + 1, d + 1))
    full[np.triu_indices(d + 1)] = flat[d + 2 :]
    return Moments(flat[0], flat[1 : d + 2], full + np.triu(full, 1).T)


def combine(a: Moments, b: Moments) -> Moments:
    """Moments of the rows of both parts."""
    if a.n <= 0 or b.n <= 0:
        return b if a.n <= 0 else a
    n = a.n + b.n
    step = b.mean - a.mean
    return Moments(n, a.mean + step * (b.n / n), a.centred + b.centred + np.outer(step, step) * (a.n * b.n / n))


def ridge(m: Moments, l2: float, used: int | None = None):
    """(intercept, weights) of the penalised least squares on the first `used` features.

    The intercept is not penalised. Weights of unused features are 0. None when no row counted.
    """
    d = len(m.mean) - 1
    used = d if used is None else used
    if m.n <= 0:
        return None
    xs = slice(0, used)
    a = m.centred[xs, xs] + l2 * np.eye(used)
    b = m.centred[xs, -1]
    try:
        w = np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        w = np.linalg.lstsq(a, b, rcond=None)[0]
    weights = np.zeros(d)
    weights[:used] = w
    return float(m.mean[-1] - weights @ m.mean[:-1]), weights


def squared_error(m: Moments, intercept: float, weights: np.ndarray) -> float:
    """Sum of squared errors of a linear model on the rows behind the moments."""
    c = np.concatenate([weights, [-1.0]])
    off = m.mean[-1] - weights @ m.mean[:-1] - intercept
    return float(max(c @ m.centred @ c, 0.0) + m.n * off * off)


def total_squares(m: Moments) -> float:
    """Sum of squares of y around its mean."""
    return float(m.centred[-1, -1]) if m.n > 0 else 0.0
