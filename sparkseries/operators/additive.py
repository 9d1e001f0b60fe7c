"""Additive ridge model: piecewise linear trend plus Fourier seasons, per series.

The model form follows Taylor & Letham, "Forecasting at Scale" (2018). The fit needs only sums
of products, and the model terms depend on the day alone. So Spark first reduces each day of a
series to (count, mean, squares around it), taken from the level of the series; the days of one (series, time block) become one d x d
sum; the few sums of a series are added and solved. No step sees more than one block of days.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.functions.timegrid import ORIGIN, day_index
from sparkseries.operators.forecast import INTERVAL_WIDTH, interval_z
from sparkseries.operators.joins import join_on

# Shape of the additive model.
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
YEARLY_PERIOD, YEARLY_ORDER = 365.25, 10
WEEKLY_PERIOD, WEEKLY_ORDER = 7.0, 3

N_TERMS = 2 + CHANGEPOINTS + 2 * YEARLY_ORDER + 2 * WEEKLY_ORDER

# Days per time block; bounds the rows one Python call receives.
BLOCK_DAYS = 1024


def design(day: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Model terms of each day: 1, trend, hinges, yearly and weekly waves."""
    span = np.maximum(last - first, 1.0)
    tau = (day - first) / span
    knots = CHANGEPOINT_RANGE * np.arange(1, CHANGEPOINTS + 1) / CHANGEPOINTS
    terms = [np.ones_like(tau), tau]
    terms.extend(np.maximum(tau[:, None] - knots, 0.0).T)
    for period, order in ((YEARLY_PERIOD, YEARLY_ORDER), (WEEKLY_PERIOD, WEEKLY_ORDER)):
        for k in range(1, order + 1):
            angle = 2 * np.pi * k * day / period
            terms += [np.sin(angle), np.cos(angle)]
    return np.column_stack(terms)


def _penalty(l2_trend: float, l2_season: float) -> np.ndarray:
    """Zero for level and slope; a trace keeps unidentified terms solvable."""
    trend = np.full(CHANGEPOINTS, l2_trend)
    season = np.full(2 * (YEARLY_ORDER + WEEKLY_ORDER), l2_season)
    return np.concatenate([[1e-10, 1e-10], trend + 1e-10, season + 1e-10])


_UPPER = np.triu_indices(N_TERMS + 1)


def _day_sums(day, n, mean, spread, first: float, last: float, level: float) -> np.ndarray:
    """Sums of products of (terms, y - level) over days that stand for `n` observations each,
    given by their mean and the sum of squares around it."""
    above = mean - level
    y, yy = n * above, spread + n * above * above
    x = design(day, np.full(len(day), first), np.full(len(day), last))
    g = np.empty((N_TERMS + 1, N_TERMS + 1))
    g[:-1, :-1] = x.T @ (x * n[:, None])
    g[:-1, -1] = g[-1, :-1] = x.T @ y
    g[-1, -1] = yy.sum()
    return g


def _solve(g: np.ndarray, penalty: np.ndarray, level: float) -> tuple:
    """(n_obs, weights, sigma); `level` goes back into the constant term."""
    xx, xy, yy = g[:-1, :-1], g[:-1, -1], g[-1, -1]
    a = xx + np.diag(penalty)
    if penalty[2:].min() > 1e-6:
        w = np.linalg.solve(a, xy)
    else:  # terms the data cannot tell apart: take the shortest solution
        w = np.linalg.lstsq(a, xy, rcond=None)[0]
    n = int(round(g[0, 0]))
    left = max(yy - 2 * w @ xy + w @ xx @ w, 0.0)
    w[0] += level
    return n, w, float(np.sqrt(left / max(n - 1, 1)))


def fit_additive_ridge(
    df: DataFrame,
    keys: Sequence[str],
    ds: str = "ds",
    y: str = "y",
    l2_trend: float = 1.0,
    l2_season: float = 0.1,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """One model row per series: (keys, n_obs, first_ds, last_ds, weights, sigma)."""
    keys = list(keys)
    v = F.col(y).cast("double")
    days = (
        df.where(F.col(y).isNotNull() & F.col(ds).isNotNull())
        .groupBy(*keys, F.col(ds).cast("date").alias("ds"))
        .agg(F.count(F.lit(1)).cast("double").alias("_n"), F.avg(v).alias("_y"), (F.count(F.lit(1)) * F.var_pop(v)).alias("_yy"))
    )
    bounds = days.groupBy(*keys).agg(
        day_index(F.min("ds")).cast("double").alias("_first"),
        day_index(F.max("ds")).cast("double").alias("_last"),
        F.count("ds").alias("_days"),
        F.min_by("_y", "ds").alias("_level"),
    )
    rows = join_on(
        days.select(*keys, day_index(F.col("ds")).cast("double").alias("_day"), "_n", "_y", "_yy"), bounds, keys
    )
    series = [*keys, "_first", "_last", "_level"]
    key_types = [rows.schema[c] for c in series]
    sums_type = T.StructType([*key_types, T.StructField("_sums", T.ArrayType(T.DoubleType()))])
    model_type = T.StructType(
        [*key_types, T.StructField("n_obs", T.LongType()),
         T.StructField("weights", T.ArrayType(T.DoubleType())), T.StructField("sigma", T.DoubleType())]
    )
    penalty = _penalty(l2_trend, l2_season)

    fields = ["_day", "_n", "_y", "_yy"]

    def sums_of(pdf: pd.DataFrame) -> list[np.ndarray]:
        columns = [pdf[c] for c in (*fields, "_first", "_last", "_level")]
        return [_day_sums(*values) for values in zip(*columns)]

    def with_models(keys_part: pd.DataFrame, sums: list[np.ndarray]) -> pd.DataFrame:
        solved = [_solve(g, penalty, level) for g, level in zip(sums, keys_part["_level"])]
        return keys_part.assign(**{c: [s[i] for s in solved] for i, c in enumerate(("n_obs", "weights", "sigma"))})

    def block_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[series].assign(_sums=[g[_UPPER] for g in sums_of(pdf)])

    def solve_series(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield with_models(pdf[series], sums_of(pdf))

    def solve_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        full = np.zeros((N_TERMS + 1, N_TERMS + 1))
        full[_UPPER] = np.sum(np.stack(pdf["_sums"].to_numpy()), axis=0)
        return with_models(pdf[series].iloc[:1], [full + np.triu(full, 1).T])

    # The days of one block travel as arrays of at most `block_days` entries, so one Arrow batch
    # carries many series. A short series is one block and is solved at once; only long ones
    # send sums on.
    lists = [F.collect_list(c).alias(c) for c in fields]
    short = rows.where(F.col("_days") <= block_days).groupBy(*series).agg(*lists).mapInPandas(solve_series, model_type)
    blocks = rows.where(F.col("_days") > block_days).withColumn("_block", F.floor(F.col("_day") / block_days))
    long = (
        blocks.groupBy(*series, "_block")
        .agg(*lists)
        .mapInPandas(block_sums, sums_type)
        .groupBy(*keys)
        .applyInPandas(solve_blocks, model_type)
    )
    model = short.unionByName(long)
    origin = F.lit(ORIGIN).cast("date")
    return model.select(
        *keys,
        "n_obs",
        F.date_add(origin, F.col("_first").cast("int")).alias("first_ds"),
        F.date_add(origin, F.col("_last").cast("int")).alias("last_ds"),
        "weights",
        "sigma",
    )


@F.pandas_udf(T.DoubleType())
def _predict(day: pd.Series, first: pd.Series, last: pd.Series, weights: pd.Series) -> pd.Series:
    if day.empty:
        return pd.Series([], dtype=float)
    x = design(day.to_numpy(float), first.to_numpy(float), last.to_numpy(float))
    return pd.Series(np.einsum("ij,ij->i", x, np.stack(weights.to_numpy())))


def predict_additive_ridge(
    rows: DataFrame, keys: Sequence[str], width: float = INTERVAL_WIDTH, keep: Sequence[str] = ()
) -> DataFrame:
    """(keys, ds, yhat, yhat_lower, yhat_upper) for rows that carry a model and a `ds`."""
    z = interval_z(width)
    out = rows.withColumn(
        "yhat",
        _predict(*[day_index(F.col(c)).cast("double") for c in ("ds", "first_ds", "last_ds")], F.col("weights")),
    )
    return out.select(
        *keys,
        "ds",
        *keep,
        "yhat",
        (F.col("yhat") - z * F.col("sigma")).alias("yhat_lower"),
        (F.col("yhat") + z * F.col("sigma")).alias("yhat_upper"),
    )
