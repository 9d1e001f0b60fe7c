"""Walk-forward backtests: all runs in one job, keyed by `runid`."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseries.operators.forecast import additive_forecast
from sparkseries.operators.joins import join_on
from sparkseries.operators.metrics import score

# Up to this many run windows travel as a literal array; more are joined by day.
LITERAL_RUNS = 500


@dataclass(frozen=True)
class RunWindow:
    """One run: train from `start` to `train_end`, evaluate up to `eval_end` (days, included)."""

    runid: int
    start: str
    train_end: str
    eval_end: str


def yearly_runs(first_year: int, n_runs: int = 5, train_years: int = 5) -> list[RunWindow]:
    """Runs that move forward one year at a time, each with one year of evaluation."""
    return [
        RunWindow(
            i + 1,
            f"{first_year + i}-01-01",
            f"{first_year + i + train_years - 1}-12-31",
            f"{first_year + i + train_years}-12-31",
        )
        for i in range(n_runs)
    ]


def _window_struct(run: RunWindow):
    return F.struct(
        F.lit(run.runid).alias("runid"),
        *[F.lit(getattr(run, c)).cast("date").alias(c) for c in ("start", "train_end", "eval_end")],
    )


def assign_runs(df: DataFrame, ds: str, runs: Sequence[RunWindow], literal_runs: int = LITERAL_RUNS) -> DataFrame:
    """One row per run whose window holds the day, with `runid` and `part` ('train' or 'eval').

    A few windows are matched by a filter on a literal array, inside the map task: no join at
    all. Many windows are spread over their days and joined by day, which Spark can shuffle or
    broadcast by size; no range condition is left to a nested loop.
    """
    first, last = min(r.start for r in runs), max(r.eval_end for r in runs)
    day = F.col(ds)
    rows = df.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    if len(runs) <= literal_runs:
        windows = F.array(*[_window_struct(r) for r in runs])
        hits = F.filter(windows, lambda w: (day >= w["start"]) & (day <= w["eval_end"]))
        rows = rows.withColumn("_w", F.explode(hits))
        runid, train_end = F.col("_w.runid"), F.col("_w.train_end")
    else:
        table = df.sparkSession.createDataFrame(
            [(r.runid, r.start, r.train_end, r.eval_end) for r in runs],
            "runid int, start string, train_end string, eval_end string",
        )
        days = table.select(
            "runid",
            F.col("train_end").cast("date").alias("_train_end"),
            F.explode(F.sequence(F.col("start").cast("date"), F.col("eval_end").cast("date"))).alias("_day"),
        )
        rows = rows.join(days, day == F.col("_day"))
        runid, train_end = F.col("runid"), F.col("_train_end")
    return rows.select(
        *df.columns,
        runid.alias("runid"),
        F.when(day <= train_end, "train").otherwise("eval").alias("part"),
    )


def run_end(runs: Sequence[RunWindow], column: str = "eval_end"):
    """The window end of the row's run, as a column expression."""
    pairs = [x for r in runs for x in (F.lit(r.runid), F.lit(getattr(r, column)).cast("date"))]
    return F.try_element_at(F.create_map(*pairs), F.col("runid"))


def walk_forward_forecast(
    series: DataFrame,
    runs: Sequence[RunWindow],
    keys: Sequence[str] = (),
    ds: str = "ds",
    y: str = "y",
    model: str = "trend_season",
    **options,
) -> DataFrame:
    """Forecasts of every run up to its own eval end, so a leap year keeps its last day."""
    train = assign_runs(series, ds, runs).where("part = 'train'")
    return additive_forecast(
        train, ["runid", *keys], ds, y, horizon=None, until=run_end(runs), model=model, **options
    )


def evaluation_rows(actuals: DataFrame, forecast: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of actuals and forecasts on explicit keys, complete rows only."""
    return join_on(actuals, forecast, on).dropna("any")


def walk_forward(
    series: DataFrame,
    runs: Sequence[RunWindow],
    keys: Sequence[str] = (),
    ds: str = "ds",
    y: str = "y",
    model: str = "trend_season",
    metrics: Sequence[str] = ("rmse",),
    **options,
) -> DataFrame:
    """Train, forecast and score every run: (runid, keys, n_rows, metrics)."""
    by = ["runid", *keys]
    forecast = walk_forward_forecast(series, runs, keys, ds, y, model, **options)
    actuals = (
        assign_runs(series, ds, runs)
        .where("part = 'eval'")
        .select(*by, F.col(ds).alias("ds"), F.col(y).alias("y"))
    )
    return score(evaluation_rows(actuals, forecast, [*by, "ds"]), "y", "yhat", by, metrics)


def compare_runs(forecast: DataFrame, actuals: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Stored forecasts next to the actuals of the same run and day.

    Both sides are cast to a date before they meet, whatever type their `ds` has.
    """
    left = forecast.withColumn("date", F.col("ds").cast("date")).drop("ds")
    right = actuals.withColumnRenamed("ds", "date").withColumn("date", F.col("date").cast("date"))
    return join_on(left, right, ["date", "runid", *keys])
