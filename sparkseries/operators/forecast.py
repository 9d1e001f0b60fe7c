"""Additive forecasts with an interval: trend plus seasonality, for all series at once.

Two model forms:

- `fit_trend_season`: straight trend and one offset per season, fitted from sums that Spark
  aggregates per (series, season). All JVM-side; one pass; the sums of two inputs can be added.
- `fit_additive_ridge`: piecewise linear trend with Fourier seasons (Taylor & Letham 2018),
  fitted from normal equations that are summed per (series, time block).
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.functions.timegrid import day_index
from sparkseries.operators.joins import join_on
from sparkseries.operators.splits import HORIZON_DAYS, INITIAL_DAYS, PERIOD_DAYS, cutoff_folds, series_bounds

# Fixed value: interval width of the additive model.
INTERVAL_WIDTH = 0.8

SEASONS = {
    "day_of_week": F.dayofweek,
    "month": F.month,
    "hour_of_day": F.hour,
}


def interval_z(width: float = INTERVAL_WIDTH) -> float:
    return NormalDist().inv_cdf(0.5 + width / 2)


def fit_trend_season(
    df: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y", season: str = "day_of_week"
) -> DataFrame:
    """One model row per series.

    slope and intercept are the least-squares line of y on the day index; season_offsets are
    the mean residuals per season; sigma is the sample deviation of what remains. A series
    without spread in time gets slope 0.
    """
    return _from_seasons(_season_sums(df, list(keys), ds, y, season), keys, season)


def _season_sums(df: DataFrame, by: Sequence, ds: str, y: str, season: str) -> DataFrame:
    """(by, _season, _n, _t, _y, _tt, _ty, _yy, _first, _last): means and sums around them."""
    # Rows that lack a side count for nothing. This is said in the sums and not as a filter, so
    # that the input's plan stays the same as where it is read for other purposes.
    both = F.col(ds).isNotNull() & F.col(y).isNotNull()
    t = F.when(both, day_index(F.col(ds)).cast("double"))
    v = F.when(both, F.col(y).cast("double"))
    # Means, and sums of products around them, so that the level of a series loses no digits.
    n = F.count(v).cast("double")
    return (
        df.groupBy(*by, SEASONS[season](F.col(ds)).alias("_season"))
        .agg(
            F.count(v).alias("_n"),
            F.avg(t).alias("_t"),
            F.avg(v).alias("_y"),
            (n * F.var_pop(t)).alias("_tt"),
            (n * F.covar_pop(t, v)).alias("_ty"),
            (n * F.var_pop(v)).alias("_yy"),
            F.min(F.when(both, F.col(ds))).alias("_first"),
            F.max(F.when(both, F.col(ds))).alias("_last"),
        )
        .where("_n > 0")
    )


def _from_seasons(sums: DataFrame, keys: Sequence[str], season: str) -> DataFrame:
    """`fit_trend_season` from the sums of its seasons."""
    total = sums.groupBy(*keys).agg(
        F.sum("_n").alias("_n"),
        # At most one entry per season.
        F.collect_list(F.struct("_season", "_n", "_t", "_y", "_tt", "_ty", "_yy")).alias("_seasons"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )
    n = F.col("_n")

    def over_seasons(value) -> Column:
        return F.aggregate("_seasons", F.lit(0.0), lambda acc, s: acc + value(s))

    base_t, base_y = F.col("_seasons")[0]["_t"], F.col("_seasons")[0]["_y"]
    total = total.withColumns({
        "_mt": base_t + over_seasons(lambda s: s["_n"] * (s["_t"] - base_t)) / n,
        "_my": base_y + over_seasons(lambda s: s["_n"] * (s["_y"] - base_y)) / n,
    })

    def far_t(s: Column) -> Column:
        return s["_t"] - F.col("_mt")

    def far_y(s: Column) -> Column:
        return s["_y"] - F.col("_my")

    tt = over_seasons(lambda s: s["_tt"] + s["_n"] * far_t(s) * far_t(s))
    ty = over_seasons(lambda s: s["_ty"] + s["_n"] * far_t(s) * far_y(s))
    total = total.withColumn("_slope", F.coalesce(F.try_divide(ty, tt), F.lit(0.0)))
    b = F.col("_slope")

    def offset(s: Column) -> Column:
        return far_y(s) - b * far_t(s)

    # What one season has left after trend and offset.
    left = over_seasons(lambda s: s["_yy"] - 2 * b * s["_ty"] + b * b * s["_tt"])
    return total.select(
        *keys,
        n.alias("n_obs"),
        F.col("_first").alias("first_ds"),
        F.col("_last").alias("last_ds"),
        b.alias("slope"),
        (F.col("_my") - b * F.col("_mt")).alias("intercept"),
        F.map_from_entries(F.transform("_seasons", lambda s: F.struct(s["_season"], offset(s)))).alias("season_offsets"),
        F.coalesce(F.sqrt(F.try_divide(F.greatest(left, F.lit(0.0)), n - 1)), F.lit(0.0)).alias("sigma"),
        F.lit(season).alias("season"),
    )


def fit_trend_season_at_cutoffs(
    df: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y", initial: int = INITIAL_DAYS, period: int = PERIOD_DAYS,
    horizon: int = HORIZON_DAYS, season: str = "day_of_week",
) -> DataFrame:
    """`fit_trend_season` of each series at each of its cutoffs, on the rows up to the cutoff.

    The cutoffs cut a series into segments. One aggregate gives the sums of each (segment, season); the
    sums up to a cutoff are running sums over the segments, taken around one point per series so that its
    level loses no digits. No row is copied, and the shuffle has one row per segment and season.
    """
    keys = list(keys)
    bounds = series_bounds(df, keys, ds, y)
    most = F.floor((F.datediff("last_ds", "first_ds") - horizon - initial) / period).cast("int")
    bounds = bounds.select(*keys, F.col("last_ds").alias("_end"), most.alias("_most")).where("_most >= 0")
    rows = join_on(df, bounds, keys)
    # Cutoff j lies horizon + j * period days before the end; a row belongs to the oldest cutoff after it.
    segment = F.least(F.floor((F.datediff("_end", F.col(ds)) - horizon) / period).cast("int"), F.col("_most"))
    rows = rows.withColumn("_segment", segment).where(F.col("_segment") >= 0)
    sums = _season_sums(rows, [*keys, "_segment"], ds, y, season)
    centre = sums.groupBy(*keys).agg((F.sum(F.col("_n") * F.col("_t")) / F.sum("_n")).alias("_bt"), (F.sum(F.col("_n") * F.col("_y")) / F.sum("_n")).alias("_by"))
    sums = join_on(sums, centre, keys)
    n, dt, dy = F.col("_n"), F.col("_t") - F.col("_bt"), F.col("_y") - F.col("_by")
    around = {
        "_n": n, "_st": n * dt, "_sy": n * dy, "_stt": F.col("_tt") + n * dt * dt, "_sty": F.col("_ty") + n * dt * dy,
        "_syy": F.col("_yy") + n * dy * dy,
    }
    sums = sums.select(*keys, "_season", "_segment", *[c.alias(k) for k, c in around.items()], "_first", "_last", "_bt", "_by")
    # Every season at every cutoff, also where a segment has none of its days.
    seasons = join_on(sums.select(*keys, "_season", "_bt", "_by").distinct(), bounds, keys)
    grid = seasons.withColumn("_segment", F.explode(F.sequence(F.lit(0), F.col("_most"))))
    full = join_on(grid, sums.drop("_bt", "_by"), [*keys, "_season", "_segment"], "left")
    older = Window.partitionBy(*keys, "_season").orderBy(F.desc("_segment")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = full.select(
        *keys, F.date_sub("_end", horizon + F.col("_segment") * period).alias("cutoff"), "_season", "_bt", "_by",
        *[F.sum(k).over(older).alias(k) for k in around], F.min("_first").over(older).alias("_first"), F.max("_last").over(older).alias("_last"),
    ).where("_n > 0")
    st, sy = F.col("_st"), F.col("_sy")
    back = full.select(
        *keys, "cutoff", "_season", n.alias("_n"), (F.col("_bt") + st / n).alias("_t"), (F.col("_by") + sy / n).alias("_y"),
        (F.col("_stt") - st * st / n).alias("_tt"), (F.col("_sty") - st * sy / n).alias("_ty"), (F.col("_syy") - sy * sy / n).alias("_yy"),
        "_first", "_last",
    )
    return _from_seasons(back, [*keys, "cutoff"], season)


def future_days(
    model: DataFrame,
    keys: Sequence[str],
    horizon: int | None = None,
    until: Column | None = None,
    include_history: bool = False,
) -> DataFrame:
    """The model rows with one `ds` per day to forecast.

    The end is `until` when given, else `horizon` days after the last observation.
    `include_history` starts at the first observation.
    """
    if (horizon is None) == (until is None):
        raise ValueError("give either a horizon or an end date")
    end = until if until is not None else F.date_add("last_ds", horizon)
    start = F.col("first_ds") if include_history else F.date_add("last_ds", 1)
    return model.withColumn("ds", F.explode(F.when(end >= start, F.sequence(start, end))))


def season_of(model: Column, ds: Column) -> Column:
    """The season number of a day under the season that a model row names."""
    number = None
    for name, of in SEASONS.items():
        number = F.when(model == name, of(ds)) if number is None else number.when(model == name, of(ds))
    return number


def predict_trend_season(
    rows: DataFrame, keys: Sequence[str], width: float = INTERVAL_WIDTH, keep=()
) -> DataFrame:
    """(keys, ds, yhat, yhat_lower, yhat_upper) for rows that carry a model and a `ds`."""
    z = interval_z(width)
    offset = F.coalesce(
        F.try_element_at("season_offsets", season_of(F.col("season"), F.col("ds"))), F.lit(0.0)
    )
    yhat = F.col("intercept") + F.col("slope") * day_index(F.col("ds")) + offset
    return rows.select(
        *keys,
        "ds",
        *keep,
        yhat.alias("yhat"),
        (yhat - z * F.col("sigma")).alias("yhat_lower"),
        (yhat + z * F.col("sigma")).alias("yhat_upper"),
    )


def additive_forecast(
    df: DataFrame,
    keys: Sequence[str],
    ds: str = "ds",
    y: str = "y",
    horizon: int | None = 365,
    until: Column | None = None,
    include_history: bool = False,
    model: str = "trend_season",
    width: float = INTERVAL_WIDTH,
    **options,
) -> DataFrame:
    """Fit and forecast every series: `model` is 'trend_season' or 'ridge'."""
    if model == "trend_season":
        fitted = fit_trend_season(df, keys, ds, y, **options)
        rows = future_days(fitted, keys, horizon, until, include_history)
        return predict_trend_season(rows, keys, width)
    if model == "ridge":
        from sparkseries.operators.additive import fit_additive_ridge, predict_additive_ridge

        fitted = fit_additive_ridge(df, keys, ds, y, **options)
        rows = future_days(fitted, keys, horizon, until, include_history)
        return predict_additive_ridge(rows, keys, width)
    raise ValueError(f"unknown model {model!r}")


def rolling_origin(
    df: DataFrame,
    keys: Sequence[str],
    ds: str = "ds",
    y: str = "y",
    initial: int = INITIAL_DAYS,
    period: int = PERIOD_DAYS,
    horizon: int = HORIZON_DAYS,
    model: str = "trend_season",
    width: float = INTERVAL_WIDTH,
) -> DataFrame:
    """Rolling-origin cross-validation: every (series, cutoff) is one model of one job.

    Returns (keys, cutoff, ds, y, yhat, yhat_lower, yhat_upper) for the test days.
    """
    span = dict(initial=initial, period=period, horizon=horizon, value="y")
    by = [*keys, "cutoff"]
    data = df.select(*keys, F.col(ds).alias("ds"), F.col(y).alias("y"))
    test = cutoff_folds(data, keys, "ds", **span, roles=["test"]).drop("role")
    if model == "trend_season":
        fitted = fit_trend_season_at_cutoffs(data, keys, "ds", "y", initial, period, horizon)
        return predict_trend_season(join_on(test, fitted, by), by, width, keep=["y"])
    train = cutoff_folds(data, keys, "ds", **span, roles=["train"])
    if model == "ridge":
        from sparkseries.operators.additive import fit_additive_ridge, predict_additive_ridge

        fitted = fit_additive_ridge(train, by)
        return predict_additive_ridge(join_on(test, fitted, by), by, width, keep=["y"])
    raise ValueError(f"unknown model {model!r}")
