"""Time-ordered splits and folds. Every split goes by rank on time, never by file order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.operators.joins import join_on
from sparkseries.operators.rank import label_by_position, with_position

# Rolling-origin folds in days (first history, step between cutoffs, test span).
INITIAL_DAYS = 700
PERIOD_DAYS = 30
HORIZON_DAYS = 90


def _ranked(df, keys, ts, block):
    return with_position(df, keys, [ts], pos="_rn", total="_n", block=block)


def labelled(df, keys, ts, label, out, block):
    """`df` with `label(position, length)`: from one ranking, or from block counts."""
    if block is not None:
        return label_by_position(df, keys, [ts], label, out, block)
    rows = _ranked(df, keys, ts, None)
    return rows.select(*df.columns, label(F.col("_rn"), F.col("_n")).alias(out))


def holdout_last(
    df: DataFrame, keys: Sequence[str], ts: str, n: int, part: str = "part", block: Column | None = None
) -> DataFrame:
    """Label the last `n` rows of each series 'test' and the others 'train'."""
    return labelled(df, keys, ts, lambda at, total: F.when(at > total - n, "test").otherwise("train"), part, block)


def holdout_fraction(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    fraction: float = 0.2,
    part: str = "part",
    block: Column | None = None,
) -> DataFrame:
    """Label the last ceil(fraction * n) rows of each series 'test'."""

    def label(at: Column, total: Column) -> Column:
        return F.when(at > total - F.ceil(total * F.lit(fraction)), "test").otherwise("train")

    return labelled(df, keys, ts, label, part, block)


def fold_segments(
    df: DataFrame, keys: Sequence[str], ts: str, k: int, out: str = "segment", block: Column | None = None
) -> DataFrame:
    """Label rows with the expanding-window segment they belong to, without copying any.

    Test size is n div (k+1). Segment 0 is the first train part; segment i (1..k) is the test
    part of fold i-1, and fold i trains on the segments 0..i. Series with fewer than k+1 rows
    have no folds: their segment is null.
    """

    def label(at: Column, total: Column) -> Column:
        size = F.floor(total / (k + 1))
        first = total - k * size
        segment = F.when(at <= first, F.lit(0)).otherwise(F.ceil(F.try_divide(at - first, size)))
        return F.when(size > 0, segment).cast("int")

    return labelled(df, keys, ts, label, out, block)


def time_series_folds(
    df: DataFrame, keys: Sequence[str], ts: str, k: int = 10, block: Column | None = None
) -> DataFrame:
    """One row per fold a reading takes part in, with `fold` (0-based) and `role`.

    This copies rows once per fold; fits that work from sums use `fold_segments` instead.
    """
    rows = fold_segments(df, keys, ts, k, out="_segment", block=block).where("_segment IS NOT NULL")
    folds = F.sequence(F.greatest(F.col("_segment") - 1, F.lit(0)), F.lit(k - 1))
    rows = rows.withColumn("fold", F.explode(folds))
    role = F.when(F.col("_segment") == F.col("fold") + 1, "test").otherwise("train")
    return rows.select(*df.columns, "fold", role.alias("role"))


def series_bounds(df: DataFrame, keys: Sequence[str], ds: str, value: str | None = None) -> DataFrame:
    """First and last day of each series; with `value`, of its rows that have one."""
    day = F.col(ds) if value is None else F.when(F.col(value).isNotNull(), F.col(ds))
    return df.groupBy(*keys).agg(F.min(day).alias("first_ds"), F.max(day).alias("last_ds"))


def cutoffs(
    df: DataFrame, keys: Sequence[str], ds: str, initial: int = INITIAL_DAYS, period: int = PERIOD_DAYS,
    horizon: int = HORIZON_DAYS,
) -> DataFrame:
    """Cutoff days of each series: from last - horizon back by `period` while at least
    `initial` days of history remain (all in days)."""
    bounds = series_bounds(df, keys, ds)
    count = F.floor(F.datediff("last_ds", "first_ds") - horizon - initial) / period
    return bounds.where(count >= 0).select(
        *keys,
        F.explode(F.sequence(F.lit(0), F.floor(count).cast("int"))).alias("_j"),
        "last_ds",
    ).select(*keys, F.date_sub("last_ds", horizon + F.col("_j") * period).alias("cutoff"))


def cutoff_folds(
    df: DataFrame,
    keys: Sequence[str],
    ds: str,
    initial: int = INITIAL_DAYS,
    period: int = PERIOD_DAYS,
    horizon: int = HORIZON_DAYS,
    roles: Sequence[str] = ("train", "test"),
    value: str | None = None,
) -> DataFrame:
    """One row per cutoff a day takes part in: 'train' up to the cutoff, 'test' in the
    `horizon` days after it.

    The cutoffs of a row follow from the day arithmetic alone, so the only join is with the
    one-row-per-series bounds. A following aggregate is combined in the map task, so the
    copies of a row are never shuffled.
    """
    rows = join_on(df, series_bounds(df, keys, ds, value), keys)
    most = F.floor((F.datediff("last_ds", "first_ds") - horizon - initial) / period)
    back = F.datediff(F.col("last_ds"), F.col(ds))
    # cutoff j lies horizon + j*period days before the last day
    newest_train = F.least(F.floor((back - horizon) / period), most)
    oldest_test = F.least(F.floor(back / period), most)
    first_test = F.greatest(F.floor((back - horizon) / period) + 1, F.lit(0))

    def spread(low, high, role):
        js = F.when(high >= low, F.sequence(low.cast("int"), high.cast("int")))
        return F.transform(js, lambda j: F.struct(j.alias("j"), F.lit(role).alias("role")))

    spreads = {
        "train": spread(F.lit(0), newest_train, "train"),
        "test": spread(first_test, oldest_test, "test"),
    }
    empty = F.array().cast("array<struct<j:int,role:string>>")
    found = F.concat(*[F.coalesce(spreads[r], empty) for r in roles])
    rows = rows.withColumn("_f", F.explode(found))
    return rows.select(
        *df.columns,
        F.date_sub("last_ds", horizon + F.col("_f.j") * period).alias("cutoff"),
        F.col("_f.role").alias("role"),
    )


def chart_frame(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    forecast: DataFrame,
    yhat: str = "yhat",
    recent: int = 150,
    test: int = 48,
    block: Column | None = None,
) -> DataFrame:
    """Recent train rows, test rows and forecasts stacked for one chart, told apart by `part`."""
    rows = _ranked(df, keys, ts, block).withColumn("_back", F.col("_n") - F.col("_rn"))
    rows = rows.where(F.col("_back") < recent + test)
    label = F.when(F.col("_back") < test, "test").otherwise("train")
    actual = rows.select(*keys, ts, F.col(value).alias("value"), label.alias("part"))
    predicted = forecast.select(*keys, ts, F.col(yhat).alias("value"), F.lit("forecast").alias("part"))
    return actual.unionByName(predicted)
