"""Synthetic series from a Gaussian copula fitted on a source panel.

The fit is one aggregate for the quantile knots and one for the correlations of the normal
scores; what reaches the driver is 201 knots per column and a d x d matrix. Draws are a hash of
the source row's id, the copy number and a seed, so a task that runs again gives the same rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_KNOTS = 201
N_GRID = 1001


@dataclass(frozen=True)
class Copula:
    """Quantile knots and normal-score correlation of numeric columns."""

    columns: tuple[str, ...]
    values: dict[str, list[float]]
    scores: dict[str, list[float]]
    correlation: list[list[float]]


def _normal_grid(n: int) -> np.ndarray:
    """Normal quantiles at the middles of n equal steps; the ends stay finite."""
    norm = NormalDist()
    return np.array([norm.inv_cdf((i + 0.5) / n) for i in range(n)])


def _interpolated(x: Column, xs, ys) -> Column:
    """Piecewise linear function through (xs, ys): linear between points of an even grid over xs,
    so the place in the table is plain arithmetic and no row leaves the JVM."""
    low, high = xs[0], xs[-1]
    if low == high:
        return F.when(x.isNotNull(), F.lit(float(ys[0])))
    grid = np.interp(np.linspace(low, high, N_GRID), xs, ys)
    table = F.expr("array(" + ", ".join(f"{v!r}D" for v in grid.tolist()) + ")")
    place = (F.least(F.greatest(x, F.lit(low)), F.lit(high)) - low) / ((high - low) / (N_GRID - 1))
    cell = F.least(F.greatest(F.floor(place), F.lit(0)), F.lit(N_GRID - 2)).cast("int")
    left, right = F.element_at(table, cell + 1), F.element_at(table, cell + 2)
    return left + (place - cell) * (right - left)


def fit_copula(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> Copula:
    """Fit on all complete rows of `columns`; runs two aggregate jobs."""
    columns = tuple(columns)
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna("any")
    steps = [i / (N_KNOTS - 1) for i in range(N_KNOTS)]
    marks = rows.agg(*[F.percentile_approx(c, steps, accuracy).alias(c) for c in columns]).first()
    if marks[columns[0]] is None:
        raise ValueError("no complete row to fit on")
    grid = _normal_grid(N_KNOTS)
    values, scores = {}, {}
    for c in columns:
        knots, where = np.unique(np.asarray(marks[c]), return_inverse=True)
        # A value that spans several knots (ties) takes their mean score.
        values[c] = knots.tolist()
        scores[c] = (np.bincount(where, grid) / np.bincount(where)).tolist()
    scored = rows.select(*[_interpolated(F.col(c), values[c], scores[c]).alias(c) for c in columns])
    # A constant column has one knot and no correlation with anything.
    varying = [c for c in columns if len(values[c]) > 1]
    pairs = list(itertools.combinations(varying, 2))
    matrix = np.eye(len(columns))
    if pairs:
        found = scored.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs]).first()
        for (a, b), r in zip(pairs, found):
            i, j = columns.index(a), columns.index(b)
            matrix[i, j] = matrix[j, i] = 0.0 if r is None or math.isnan(r) else r
    return Copula(columns, values, scores, matrix.tolist())


def _uniform(ids: Sequence[str], copy: Column, stream: int, seed: int) -> Column:
    """Uniform in (0, 1) from a hash of the row id, the copy, the stream and the seed."""
    h = F.xxhash64(*[F.col(c) for c in ids], copy, F.lit(stream), F.lit(seed))
    return (F.shiftrightunsigned(h, 11) + F.lit(0.5)) / F.lit(float(2**53))


def synthesize(
    df: DataFrame,
    copula: Copula,
    ids: Sequence[str],
    copies: Sequence[int],
    series: str = "series",
    keep: Sequence[str] = (),
    seed: int = 11,
    own: int | None = None,
) -> DataFrame:
    """One synthetic row per source row and copy number, labelled in `series`. The copy number
    `own`, if given, holds the source's own values.

    The `keep` columns (the time grid) are taken over; the copula columns are draws. `ids` must
    identify a source row. Draws are independent between rows, like those of the source method.
    """
    rows = df.withColumn(series, F.explode(F.array(*[F.lit(int(c)) for c in copies if c != own]).cast("array<int>")))
    d = len(copula.columns)
    root = np.linalg.cholesky(np.asarray(copula.correlation) + 1e-9 * np.eye(d))
    for i in range(d):
        u1 = _uniform(ids, F.col(series), 2 * i, seed)
        u2 = _uniform(ids, F.col(series), 2 * i + 1, seed)
        rows = rows.withColumn(f"_e{i}", F.sqrt(-2 * F.log(u1)) * F.cos(2 * math.pi * u2))
    drawn = {}
    for i, c in enumerate(copula.columns):
        z = sum((F.lit(float(root[i, j])) * F.col(f"_e{j}") for j in range(i + 1)), F.lit(0.0))
        rows = rows.withColumn(f"_z{i}", z)
        drawn[c] = _interpolated(F.col(f"_z{i}"), copula.scores[c], copula.values[c])
    drawn = rows.select(series, *keep, *[v.alias(c) for c, v in drawn.items()])
    if own is None:
        return drawn
    # One more narrow scan: inside a condition each draw's shared parts would be computed many times.
    return df.select(F.lit(int(own)).alias(series), *keep, *[F.col(c).cast("double").alias(c) for c in copula.columns]).unionByName(drawn)


def synthetic_panel(
    df: DataFrame,
    columns: Sequence[str],
    ids: Sequence[str],
    n_series: int = 5,
    series: str = "series",
    keep: Sequence[str] = (),
    seed: int = 11,
) -> DataFrame:
    """The source rows as series 1 and `n_series - 1` synthetic ones on the same time grid."""
    return synthesize(df, fit_copula(df, columns), ids, range(1, n_series + 1), series, keep, seed, own=1)
