"""Window features: lags, moving averages, exponential averages, feature vectors."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.operators.joins import join_on
from sparkseries.operators.rank import with_neighbours, with_position

# The lag set of the hourly panel (hours; 168 is one week).
HOURLY_LAGS = (1, 2, 3, 4, 5, 12, 24, 168)


def lag_names(value: str, lags: Sequence[int]) -> list[str]:
    return [f"{value}_lag{k}" for k in lags]


def lag_features(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    lags: Sequence[int] = HOURLY_LAGS,
    block: Column | None = None,
    chunk_rows: int = 100_000,
) -> DataFrame:
    """Add one column per lag. Lags count rows, so a missing hour is not filled.

    All lags share one window and therefore one shuffle and one sort.
    """
    rows, window, home = with_neighbours(df, keys, [ts], max(lags), 0, block, chunk_rows)
    cols = {name: F.lag(value, k).over(window) for name, k in zip(lag_names(value, lags), lags)}
    out = rows.withColumns(cols)
    if home is not None:
        out = out.where(home)
    return out.select(*df.columns, *cols)


def lag_table(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, lags: Sequence[int] = HOURLY_LAGS, **options
) -> DataFrame:
    """Lag features with the incomplete warm-up rows removed."""
    return lag_features(df, keys, ts, value, lags, **options).dropna("any")


def moving_average(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    width: int,
    centred: bool = True,
    out: str = "smooth",
    block: Column | None = None,
    chunk_rows: int = 100_000,
) -> DataFrame:
    """Mean of `width` neighbouring rows; shorter at the ends of a series."""
    before = width // 2 if centred else width - 1
    after = width - 1 - before
    rows, window, home = with_neighbours(df, keys, [ts], before, after, block, chunk_rows)
    rows = rows.withColumn(out, F.avg(value).over(window.rowsBetween(-before, after)))
    if home is not None:
        rows = rows.where(home)
    return rows.select(*df.columns, out)


def ema(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    alpha: float,
    out: str = "ema",
    block: Column | None = None,
) -> DataFrame:
    """Exponential moving average, e[0] = y[0], e[t] = alpha*y[t] + (1-alpha)*e[t-1].

    The recurrence is a weighted running sum: with q = 1 - alpha, e[t] = q^t * sum(a_k * y_k *
    q^-k). It is taken over runs of `span` rows, chosen so that q^-span cannot overflow, and
    the averages at the ends of the two runs before are carried in; a third one would have the
    weight q^(2*span) < 1e-390, which is 0 in a double. A null value has a null average and
    does not move the next one.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be in (0, 1]")
    if alpha == 1:
        return df.withColumn(out, F.col(value).cast("double"))
    q = 1.0 - alpha
    span = max(2, int(195 / -math.log10(q)))
    part = [*keys, "_null"]
    rows = with_position(
        df.withColumn("_null", F.col(value).isNull()), part, [ts], pos="_pos", block=block
    )
    rows = rows.withColumns(
        {
            "_run": F.floor((F.col("_pos") - 1) / span),
            "_i": ((F.col("_pos") - 1) % span).cast("double"),
        }
    )
    weight = F.when(F.col("_pos") == 1, 1.0).otherwise(alpha)
    within = Window.partitionBy(*part, "_run").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    power = F.pow(F.lit(q), F.col("_i"))
    rows = rows.withColumn("_local", F.sum(weight * F.col(value) / power).over(within) * power)

    last = F.max(F.when(F.col("_i") == span - 1, F.col("_local")))
    if block is None:
        # One series per window: earlier runs are reached by a range frame, without a join.
        runs = Window.partitionBy(*part).orderBy("_run")
        rows = rows.withColumns(
            {f"_tail{k}": last.over(runs.rangeBetween(-k, -k)) for k in (1, 2)}
        )
    else:
        ends = rows.where(F.col("_i") == span - 1)
        for k in (1, 2):
            tail = ends.select(*part, (F.col("_run") + k).alias("_run"), F.col("_local").alias(f"_tail{k}"))
            rows = join_on(rows, tail, [*part, "_run"], "left")
    carried = F.coalesce(F.col("_tail1"), F.lit(0.0)) + F.lit(q**span) * F.coalesce(
        F.col("_tail2"), F.lit(0.0)
    )
    average = F.col("_local") + power * F.lit(q) * carried
    return rows.select(*df.columns, F.when(~F.col("_null"), average).alias(out))


def feature_vector(df: DataFrame, inputs: Sequence[str], out: str = "features") -> DataFrame:
    """Assemble numeric columns into one ML vector column."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(inputs), outputCol=out).transform(df)
