"""One linear model per series on lag features, and user models per series.

The linear fit needs one row of sums per series. Spark aggregates the sums with map-side
combine, so a series that holds most of the rows costs one partial row per task. Only the
d x d solve runs in Python. Scores are one step ahead: test rows carry their true lags.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.functions import linalg
from sparkseries.operators.joins import join_on
from sparkseries.operators.metrics import score
from sparkseries.operators.splits import holdout_fraction


def moments(df: DataFrame, keys: Sequence[str], features: Sequence[str], y: str, out: str = "moments") -> DataFrame:
    """Packed row count, means and centred sums of products of (features, y) per key, JVM-side.

    Variances and covariances are merged around their means by Spark, so the level of a series
    does not matter.
    """
    cols = [*[F.col(f).cast("double") for f in features], F.col(y).cast("double")]
    n = F.count(F.lit(1)).cast("double")
    means = [F.avg(c) for c in cols]
    centred = [
        n * (F.var_pop(cols[i]) if i == j else F.covar_pop(cols[i], cols[j]))
        for i in range(len(cols))
        for j in range(i, len(cols))
    ]
    complete = df.dropna("any", subset=[*features, y])
    return complete.groupBy(*keys).agg(F.array(n, *means, *centred).alias(out))


MODEL_FIELDS = [
    T.StructField("n_train", T.LongType()),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("weights", T.ArrayType(T.DoubleType())),
    T.StructField("means", T.ArrayType(T.DoubleType())),
]


def fit_ridge(df: DataFrame, keys: Sequence[str], features: Sequence[str], y: str, l2: float = 1.0) -> DataFrame:
    """(keys, n_train, intercept, weights, means): one ridge model per series."""
    keys, d = list(keys), len(features)
    sums = moments(df, keys, features, y)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[keys].copy()
            full = [linalg.unpack(p, d) for p in pdf["moments"]]
            models = [linalg.ridge(m, l2) for m in full]
            out["n_train"] = [int(m.n) for m in full]
            out["intercept"] = [b for b, _ in models]
            out["weights"] = [w for _, w in models]
            out["means"] = [m.mean[:-1] for m in full]
            yield out

    schema = T.StructType([*(sums.schema[k] for k in keys), *MODEL_FIELDS])
    return sums.mapInPandas(solve, schema)


def linear_yhat(features: Sequence[str], weights: str = "weights", intercept: str = "intercept") -> Column:
    """Prediction of a joined linear model as a plain column expression."""
    total = F.col(intercept)
    for i, name in enumerate(features):
        total = total + F.col(weights)[i] * F.col(name)
    return total


def predict_ridge(df: DataFrame, model: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Add `yhat`. The model side has one row per series; AQE broadcasts it when it is small."""
    joined = join_on(df, model.select(*keys, "intercept", "weights"), keys)
    return joined.select(*df.columns, linear_yhat(features).alias("yhat"))


def per_series_scores(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    features: Sequence[str],
    y: str,
    l2: float = 1.0,
    fraction: float = 0.2,
    metrics: Sequence[str] = ("rmse", "mape"),
) -> DataFrame:
    """Fit each series on its first rows and score its last `fraction`: (keys, n_rows, metrics)."""
    parts = holdout_fraction(df, keys, ts, fraction)
    model = fit_ridge(parts.where("part = 'train'"), keys, features, y, l2)
    test = predict_ridge(parts.where("part = 'test'"), model, keys, features)
    return score(test, y, "yhat", keys, metrics)


def apply_per_series(
    df: DataFrame,
    keys: Sequence[str],
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
) -> DataFrame:
    """A user's own model per series: `fn` gets one whole series as pandas.

    Give it resampled series, whose length the time span bounds.
    """
    return df.groupBy(*keys).applyInPandas(fn, schema)


def linear_contributions(
    df: DataFrame, model: DataFrame, keys: Sequence[str], features: Sequence[str]
) -> DataFrame:
    """Per-row attribution of a linear model: contribution = weight * (x - mean of x).

    Adds `base` (the prediction at the means) and one `<feature>_contribution` per feature;
    base plus contributions is the prediction.
    """
    joined = join_on(df, model.select(*keys, "intercept", "weights", "means"), keys)
    base = F.col("intercept")
    for i in range(len(features)):
        base = base + F.col("weights")[i] * F.col("means")[i]
    parts = [
        (F.col("weights")[i] * (F.col(f) - F.col("means")[i])).alias(f"{f}_contribution")
        for i, f in enumerate(features)
    ]
    return joined.select(*df.columns, base.alias("base"), *parts)


def mean_attribution(contributions: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per series and feature, in long form."""
    wide = contributions.groupBy(*keys).agg(
        *[F.avg(F.abs(f"{f}_contribution")).alias(f) for f in features]
    )
    return wide.unpivot(list(keys), list(features), "feature", "mean_abs_contribution")


def top_attribution(
    contributions: DataFrame, ids: Sequence[str], features: Sequence[str], n: int | None = None
) -> DataFrame:
    """Contributions of each row in long form, ranked by size (a waterfall per row)."""
    entries = F.array(
        *[
            F.struct(
                (-F.abs(F.col(f"{f}_contribution"))).alias("order"),
                F.lit(f).alias("feature"),
                F.col(f"{f}_contribution").alias("contribution"),
            )
            for f in features
        ]
    )
    ranked = F.array_sort(entries)
    if n is not None:
        ranked = F.slice(ranked, 1, n)
    rows = contributions.select(*ids, F.posexplode(ranked).alias("_p", "_e"))
    return rows.select(
        *ids, (F.col("_p") + 1).alias("rank"), F.col("_e.feature").alias("feature"),
        F.col("_e.contribution").alias("contribution"),
    )
