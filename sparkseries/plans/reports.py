"""Result tables behind the dashboard: forecast quality over time, forecast against actual."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseries.functions.scoring import absolute_percentage
from sparkseries.operators.features import ema
from sparkseries.operators.forecast import fit_trend_season, predict_trend_season
from sparkseries.operators.joins import join_on
from sparkseries.operators.metrics import exact_median


def forecast_quality(rows: DataFrame, version: str, ds: str, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """(max_date, mdape, model_version): one row per model version."""
    keyed = rows.withColumn("model_version", F.col(version)).withColumn(
        "_ape", absolute_percentage(F.col(y), F.col(yhat))
    )
    last = keyed.groupBy("model_version").agg(F.max(ds).alias("max_date"))
    middle = exact_median(keyed, ["model_version"], "_ape", "mdape")
    return join_on(last, middle, ["model_version"], "left").select("max_date", "mdape", "model_version")


def forecast_and_actuals(
    hourly: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    alpha: float = 0.1,
    season: str = "hour_of_day",
) -> DataFrame:
    """(keys, ts, hourly_<value>, hourly_ema_<value>, yhat) per series and hour.

    `yhat` is the fitted trend plus season of the same series. The model is one row per series,
    so joining it back moves no hourly row when it fits a broadcast.
    """
    smoothed = ema(hourly, keys, ts, value, alpha, out=f"hourly_ema_{value}")
    model = fit_trend_season(hourly, keys, ts, value, season=season)
    rows = join_on(smoothed, model, keys).withColumn("ds", F.col(ts))
    out = predict_trend_season(rows, keys, keep=[value, f"hourly_ema_{value}"])
    return out.select(
        *keys, F.col("ds").alias(ts), F.col(value).alias(f"hourly_{value}"), f"hourly_ema_{value}", "yhat"
    )
