"""The layered forecast job: bronze and silver tables, model, gold forecast, evaluation.

Every step reads the layer before it and writes one Parquet table partitioned by `runid`. All
runs go through a step together; the counts that a run log wants are observed in the writes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkseries.operators.clean import as_date, between_dates, complete_rows, to_series
from sparkseries.operators.forecast import fit_trend_season, future_days, predict_trend_season
from sparkseries.operators.metrics import score
from sparkseries.plans.backtest import RunWindow, assign_runs, evaluation_rows, run_end
from sparkseries.sources.layers import read_layer, write_layer
from sparkseries.sources.registry import append_runs, checked_model, long_runs, register_model, schema_signature

PARTS = ("train", "eval")


def bronze(raw: DataFrame, date: str, runs: Sequence[RunWindow], part: str) -> DataFrame:
    """Raw rows of one part of every run, tagged with `runid`.

    The evaluation part starts after the train end; training years could never join a
    forecast.
    """
    # The outer bounds are on the raw column, so they reach the file scan.
    rows = between_dates(raw, date, min(r.start for r in runs), max(r.eval_end for r in runs))
    rows = rows.withColumn("_day", as_date(raw, date))
    return assign_runs(rows, "_day", runs).where(F.col("part") == part).drop("_day", "part")


def silver(rows: DataFrame, date: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """(runid, keys, ds, y): renamed, typed and complete."""
    return complete_rows(to_series(rows, date, value, ["runid", *keys]))


def run_layers(
    raw: DataFrame,
    date: str,
    value: str,
    runs: Sequence[RunWindow],
    base: str,
    experiment: str,
    keys: Sequence[str] = (),
    model_name: str = "trend_season",
) -> DataFrame:
    """Write all layers, the model, the gold forecast and the run log; returns the run scores."""
    spark: SparkSession = raw.sparkSession
    ids = [r.runid for r in runs]
    for part in PARTS:
        write_layer(bronze(raw, date, runs, part), f"{base}/bronze_{part}", runs=ids)
        typed = silver(read_layer(spark, f"{base}/bronze_{part}", ids), date, value, keys)
        write_layer(typed, f"{base}/silver_{part}", runs=ids)
    by = ["runid", *keys]
    train = read_layer(spark, f"{base}/silver_train", ids)
    model = fit_trend_season(train, by)
    forecast = predict_trend_season(future_days(model, by, until=run_end(runs)), by)
    register_model(spark, f"{base}/models", model_name, model, schema_signature(train, forecast))

    stored = checked_model(spark, f"{base}/models", model_name, train)
    forecast = predict_trend_season(future_days(stored, by, until=run_end(runs)), by)
    write_layer(forecast, f"{base}/gold_forecast", runs=ids)

    scores = evaluate_layers(spark, base, keys)
    counts = layer_counts(spark, base)
    lost = [(F.col(f"bronze_{p}_count") - F.coalesce(f"silver_{p}_count", F.lit(0))).alias(f"{p}_dropped_count") for p in PARTS]
    per_run = score_runs(spark, base).join(counts.select("*", *lost), "runid", "left")
    windows = spark.createDataFrame(
        [(r.runid, r.start, r.train_end, r.eval_end) for r in runs],
        "runid int, start string, train_end string, eval_end string",
    )
    log = long_runs(
        per_run.join(windows, "runid"),
        experiment,
        "runid",
        params=["start", "train_end", "eval_end"],
        metrics=[c for c in per_run.columns if c != "runid"],
    )
    append_runs(log, f"{base}/runs")
    return scores


def layer_counts(spark: SparkSession, base: str) -> DataFrame:
    """Rows per run of each bronze and silver layer, side by side.

    Counting Parquet rows by partition column reads no data columns.
    """
    out = None
    for layer in ("bronze", "silver"):
        for part in PARTS:
            name = f"{layer}_{part}_count"
            counts = read_layer(spark, f"{base}/{layer}_{part}").groupBy("runid").agg(F.count(F.lit(1)).alias(name))
            out = counts if out is None else out.join(counts, "runid", "full")
    return out


def evaluate_layers(spark: SparkSession, base: str, keys: Sequence[str] = (), metrics: Sequence[str] = ("rmse",)) -> DataFrame:
    """Score the gold forecast against the silver evaluation layer, per run and series."""
    on = ["runid", *keys, "ds"]
    rows = evaluation_rows(read_layer(spark, f"{base}/silver_eval"), read_layer(spark, f"{base}/gold_forecast"), on)
    return score(rows, "y", "yhat", on[:-1], metrics)


def score_runs(spark: SparkSession, base: str) -> DataFrame:
    """RMSE and row count per run over all its series."""
    silver_eval = read_layer(spark, f"{base}/silver_eval")
    gold = read_layer(spark, f"{base}/gold_forecast")
    on = [c for c in silver_eval.columns if c in gold.columns]
    rows = evaluation_rows(silver_eval, gold, on)
    return score(rows, "y", "yhat", ["runid"], ["rmse"]).withColumnRenamed("n_rows", "eval_forecast_count")
