"""Scoring of forecasts: by key, by horizon, wide and long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.functions import scoring
from sparkseries.operators.joins import join_on

PLAIN = {
    "mse": scoring.mse,
    "rmse": scoring.rmse,
    "mae": scoring.mae,
    "mape": scoring.mape,
    "smape": scoring.smape,
    "wape": scoring.wape,
    "r2": scoring.r2,
    "mean_error": scoring.mean_error,
    "max_error": scoring.max_error,
}
ALL_METRICS = (*PLAIN, "mdape", "coverage")
# Fixed value: the measures that a cross-validation by horizon reports.
HORIZON_METRICS = ("mse", "rmse", "mae", "mdape", "smape", "coverage")

# Relative rank error allowed to the sketch that brackets an exact median.
_SKETCH_ACCURACY = 10_000
_MEDIAN_BINS = 10_000


def exact_median(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact median per group without holding a group in one task.

    A quantile sketch gives two values that surround the median. Rows below are only counted;
    the few rows between are counted by value in narrow bins. Running counts over the bins, at
    most `_MEDIAN_BINS` per group, tell which bin holds the middle ranks, and only the values
    of that bin are ordered.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    margin = 2.0 / _SKETCH_ACCURACY
    marks = rows.groupBy(*by).agg(
        F.count("_v").alias("_n"),
        F.percentile_approx("_v", [0.5 - margin, 0.5 + margin], _SKETCH_ACCURACY).alias("_mark"),
    )
    rows = join_on(rows, marks, by)
    low, high, v = F.col("_mark")[0], F.col("_mark")[1], F.col("_v")
    # Rows below the bracket form one counting row per group: bin -1, no value.
    place = F.coalesce(F.try_divide(v - low, high - low), F.lit(0.0)) * _MEDIAN_BINS
    counted = (
        rows.where(v <= high)
        .groupBy(
            *by,
            F.when(v >= low, F.floor(place)).otherwise(F.lit(-1)).alias("_bin"),
            F.when(v >= low, v).alias("_v"),
        )
        .agg(F.count(F.lit(1)).alias("_c"), F.max("_n").alias("_n"))
    )
    r1 = F.floor((F.col("_n") + 1) / 2)
    r2 = F.floor(F.col("_n") / 2) + 1
    before = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    middle = (
        counted.groupBy(*by, "_bin")
        .agg(F.sum("_c").alias("_size"), F.max("_n").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .where((F.col("_start") < r2) & (F.col("_start") + F.col("_size") >= r1))
        .select(*by, "_bin", "_start")
    )
    inside = Window.partitionBy(*by, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        join_on(counted, middle, [*by, "_bin"])
        .withColumn("_hi", F.col("_start") + F.sum("_c").over(inside))
        .withColumn("_lo", F.col("_hi") - F.col("_c") + 1)
    )

    def at(rank: Column) -> Column:
        return F.max(F.when(rank.between(F.col("_lo"), F.col("_hi")), F.col("_v")))

    return ranked.groupBy(*by).agg(((at(r1) + at(r2)) / 2).alias(out))


def score(
    df: DataFrame,
    y: str,
    yhat: str,
    by: Sequence[str] = (),
    metrics: Sequence[str] = ("mse", "rmse", "mae", "mape", "smape", "wape"),
    lower: str = "yhat_lower",
    upper: str = "yhat_upper",
    median: str = "exact",
) -> DataFrame:
    """All asked measures in one aggregate.

    `median` sets how MdAPE is found: 'exact' for groups of any size (see `exact_median`),
    'grouped' for an exact percentile where groups are known to be short, 'approx' for a
    sketch.
    """
    unknown = set(metrics) - set(ALL_METRICS)
    if unknown:
        raise ValueError(f"unknown metrics {sorted(unknown)}")
    a, p = F.col(y), F.col(yhat)
    ape = scoring.absolute_percentage(a, p)
    aggs: dict[str, Column] = {}
    for name in metrics:
        if name in PLAIN:
            aggs[name] = PLAIN[name](a, p)
        elif name == "coverage":
            aggs[name] = scoring.coverage(a, F.col(lower), F.col(upper))
        elif median == "grouped":
            aggs[name] = F.median(ape)
        elif median == "approx":
            aggs[name] = F.percentile_approx(ape, 0.5, _SKETCH_ACCURACY)
    out = df.groupBy(*by).agg(
        F.count(scoring.paired(a, p, F.lit(1))).alias("n_rows"), *[agg.alias(n) for n, agg in aggs.items()]
    )
    if "mdape" in metrics and "mdape" not in aggs:
        middle = exact_median(df.withColumn("_ape", ape), by, "_ape", "mdape")
        out = join_on(out, middle, by, "left")
    return out.select(*by, "n_rows", *metrics)


def score_by_horizon(
    df: DataFrame,
    y: str,
    yhat: str,
    ds: str,
    cutoff: str = "cutoff",
    by: Sequence[str] = (),
    window: int = 1,
    horizon: int | None = None,
    metrics: Sequence[str] = HORIZON_METRICS,
    **options,
) -> DataFrame:
    """Measures by days ahead of the cutoff, rolling over the last `window` horizons.

    A measure, also a median, is taken over all rows of its window. Horizons with an unfilled
    window are left out. With window 1 this is the plain score per horizon. `horizon` is the longest
    one; where it is not given it is read from the rows. Rows are aggregated per horizon, and the
    sums of a horizon count for the windows that reach back to it; only `r2` and an approximate
    median copy the rows.
    """
    rows = df.withColumn("horizon", F.datediff(F.col(ds), F.col(cutoff)))
    if window == 1:
        return score(rows, y, yhat, [*by, "horizon"], metrics, **options)
    if horizon is None:
        rows = join_on(rows, rows.groupBy(*by).agg(F.max("horizon").alias("_last")), by)
    else:
        rows = rows.withColumn("_last", F.lit(horizon))
    approximate = "mdape" in metrics and options.get("median") == "approx"
    if approximate or not set(metrics) <= {*WINDOWED, "mdape"}:
        rows = _reaching(rows, window).drop("_last")
        return score(rows, y, yhat, [*by, "horizon"], metrics, **options)
    return _score_windows(rows, y, yhat, by, window, metrics, options.get("lower", "yhat_lower"), options.get("upper", "yhat_upper"))


def _reaching(rows: DataFrame, window: int) -> DataFrame:
    """A copy of each row (here: of a horizon's sums) for every horizon whose window reaches back to it."""
    first = F.greatest(F.col("horizon"), F.lit(window))
    final = F.least(F.col("horizon") + window - 1, F.col("_last"))
    return rows.withColumn("horizon", F.explode(F.when(final >= first, F.sequence(first, final))))


# Measures whose window follows from sums or maxima per horizon: row value, and what is made of the sums.
WINDOWED = ("mse", "rmse", "mae", "mape", "smape", "wape", "mean_error", "max_error", "coverage")


def _row_values(y: Column, yhat: Column, lower: Column, upper: Column) -> dict[str, Column]:
    error = y - yhat
    ratio = F.try_divide(F.abs(error), (F.abs(y) + F.abs(yhat)) / 2)
    return {
        "square": error * error, "absolute": F.abs(error), "error": error, "percentage": scoring.floored_percentage(y, yhat),
        "symmetric": F.when((y == 0) & (yhat == 0), 0.0).otherwise(ratio), "actual": scoring.paired(y, yhat, F.abs(y)),
        "inside": ((y >= lower) & (y <= upper)).cast("double"),
    }


MEANS = {"mse": "square", "rmse": "square", "mae": "absolute", "mape": "percentage", "smape": "symmetric", "mean_error": "error", "coverage": "inside"}


def _score_windows(rows: DataFrame, y: str, yhat: str, by: Sequence[str], window: int, metrics: Sequence[str], lower: str, upper: str) -> DataFrame:
    """`score_by_horizon` from sums per horizon; `rows` carry `horizon` and the longest one, `_last`."""
    by = list(by)
    a, p = F.col(y), F.col(yhat)
    bounds = (F.col(lower), F.col(upper)) if "coverage" in metrics else (F.lit(None), F.lit(None))
    values = _row_values(a, p, *bounds)
    used = {MEANS[m] for m in metrics if m in MEANS} | ({"absolute", "actual"} if "wape" in metrics else set())
    sums = rows.groupBy(*by, "horizon").agg(
        F.max("_last").alias("_last"),
        F.count(scoring.paired(a, p, F.lit(1))).alias("n_rows"),
        F.max(values["absolute"]).alias("_max"),
        *[F.sum(values[v]).alias(f"_s_{v}") for v in sorted(used)],
        *[F.count(values[v]).alias(f"_n_{v}") for v in sorted(used)],
    )
    wide = _reaching(sums, window).groupBy(*by, "horizon").agg(
        F.sum("n_rows").alias("n_rows"), F.max("_max").alias("_max"),
        *[F.sum(f"_{k}_{v}").alias(f"_{k}_{v}") for v in sorted(used) for k in ("s", "n")],
    )
    found = {m: F.try_divide(F.col(f"_s_{v}"), F.col(f"_n_{v}")) for m, v in MEANS.items() if v in used}
    if "square" in used:
        found["rmse"] = F.sqrt(found["mse"])
    if "wape" in metrics:
        found["wape"] = F.try_divide(F.col("_s_absolute"), F.col("_s_actual"))
    found["max_error"] = F.col("_max")
    out = wide.select(*by, "horizon", "n_rows", *[found[m].alias(m) for m in metrics if m != "mdape"])
    if "mdape" in metrics:
        ape = rows.select(*by, "horizon", "_last", scoring.absolute_percentage(a, p).alias("_v"))
        out = join_on(out, _window_medians(ape, by, window), [*by, "horizon"], "left")
    return out.select(*by, "horizon", "n_rows", *metrics)


def _window_medians(rows: DataFrame, by: Sequence[str], window: int) -> DataFrame:
    """(by, horizon, mdape): exact medians over windows of horizons, of values >= 0.

    Values are counted per horizon in bins of about one per cent of their size. Sums of these counts
    over a window, and running sums over its bins, tell which bins hold its middle ranks. Only the values
    in such bins are looked at again, counted by value, for the windows that need them.
    """
    rows = rows.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    rows = rows.withColumn("_bin", F.when(F.col("_v") > 0, F.floor(F.log2("_v") * 64)).otherwise(F.lit(-(1 << 20)).cast("long")))
    counts = rows.groupBy(*by, "horizon", "_bin").agg(F.max("_last").alias("_last"), F.count(F.lit(1)).alias("_c"))
    wide = _reaching(counts, window).groupBy(*by, "horizon", "_bin").agg(F.sum("_c").alias("_c"))
    group = Window.partitionBy(*by, "horizon")
    upto = F.sum("_c").over(group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    wide = wide.withColumns({"_upto": upto, "_n": F.sum("_c").over(group)})
    r1, r2 = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    middle = wide.where((F.col("_upto") - F.col("_c") < r2) & (F.col("_upto") >= r1))
    middle = middle.select(*by, F.col("horizon").alias("_window"), "_bin", (F.col("_upto") - F.col("_c")).alias("_start"), "_n")
    # Which horizons' rows each of these windows needs.
    needed = middle.withColumn("horizon", F.explode(F.sequence(F.col("_window") - window + 1, F.col("_window"))))
    inside = join_on(rows.select(*by, "horizon", "_bin", "_v"), needed, [*by, "horizon", "_bin"])
    counted = inside.groupBy(*by, "_window", "_bin", "_start", "_n", "_v").agg(F.count(F.lit(1)).alias("_c"))
    along = Window.partitionBy(*by, "_window", "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_hi", F.col("_start") + F.sum("_c").over(along)).withColumn("_lo", F.col("_hi") - F.col("_c") + 1)

    def at(rank: Column) -> Column:
        return F.max(F.when(rank.between(F.col("_lo"), F.col("_hi")), F.col("_v")))

    out = ranked.groupBy(*by, F.col("_window").alias("horizon")).agg(((at(r1) + at(r2)) / 2).alias("mdape"))
    return out


def mean_over_horizons(scores: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Plain mean of each measure over all horizons."""
    return scores.groupBy(*by).agg(*[F.avg(m).alias(m) for m in metrics])


def all_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (), **options) -> DataFrame:
    """Every measure that needs no interval, one row per group and measure."""
    names = [m for m in ALL_METRICS if m != "coverage"]
    wide = score(df, y, yhat, by, names, **options)
    return wide.unpivot(list(by), names, "metric", "value")


def best_candidate(
    scores: DataFrame, by: Sequence[str], candidate: str, metric: str, smaller_is_better: bool = True
) -> DataFrame:
    """The best-scored row per series; equal scores go to the smallest candidate id."""
    ranked = F.col(metric) if smaller_is_better else -F.col(metric)
    row = F.struct(*[F.col(c) for c in scores.columns if c not in by])
    best = (
        scores.where(F.col(metric).isNotNull() & ~F.isnan(metric))
        .groupBy(*by)
        .agg(F.min_by(row, F.struct(ranked, F.col(candidate))).alias("_best"))
    )
    return best.select(*by, "_best.*")
