"""Registered queries over the given tables, each with the SQL that must give the same rows.

Series used: `events` by `event_type` (hourly means), `orders` by day (sum of order value), in
total or by `o_orderpriority`. All of them are pre-aggregated by time bucket before any window,
so a window sees at most one row per series and bucket.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkseries.functions.text import parse_timestamp, to_number
from sparkseries.functions.timegrid import bucket
from sparkseries.operators import attribution, clean, ensemble, features, forecast, metrics, models, quality, search, smoothing, splits, synth, tuning
from sparkseries.operators.joins import join_on
from sparkseries.operators.resample import resample
from sparkseries.plans import backtest, layers, reports
from sparkseries.session import kept
from sparkseries.sources import layers as layer_io
from sparkseries.sources import registry

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with its SQL twin if there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, places) + F.lit(0.0) for n in names})


# --------------------------------------------------------------------------- inputs

SERIES = ["event_type"]
RUNS = backtest.yearly_runs(1995, n_runs=5, train_years=2)


def readings(spark, sf):
    """Raw text readings: day/month/year, clock time, decimal comma, '?' for tiny values."""
    comma = F.regexp_replace(F.col("value").cast("string"), r"\.", ",")
    return table(spark, sf, "events").select(
        "event_id",
        "event_type",
        F.date_format("ts", "d/M/yyyy").alias("Date"),
        F.date_format("ts", "HH:mm:ss").alias("Time"),
        F.when(F.col("value") < 0.5, "?").otherwise(comma).alias("reading"),
    )


def hourly(spark, sf):
    return resample(table(spark, sf, "events"), SERIES, "ts", "value", "hour")


def daily(spark, sf):
    """Total order value per day, one series."""
    orders = table(spark, sf, "orders")
    days = resample(orders, [], "o_orderdate", {"y": F.sum("o_totalprice")}, "day")
    return days.select(F.to_date("o_orderdate").alias("ds"), "y")


def daily_by_priority(spark, sf):
    orders = table(spark, sf, "orders")
    days = resample(orders, ["o_orderpriority"], "o_orderdate", {"y": F.sum("o_totalprice")}, "day")
    return days.select(F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("ds"), "y")


def lagged(spark, sf, lags=features.HOURLY_LAGS):
    return features.lag_table(hourly(spark, sf), SERIES, "ts", "value", lags)


def baseline(spark, sf):
    """Hourly value against the hour before, with a fixed band: a frame to score."""
    rows = features.lag_table(hourly(spark, sf), SERIES, "ts", "value", [1])
    return rows.select(
        "event_type",
        "ts",
        F.col("value").alias("y"),
        F.col("value_lag1").alias("yhat"),
        (F.col("value_lag1") - 10).alias("yhat_lower"),
        (F.col("value_lag1") + 10).alias("yhat_upper"),
    )


HOURLY_SQL = "h AS (SELECT event_type, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2)"
READINGS_SQL = (
    "p AS (SELECT event_id, event_type, date_trunc('second', ts) AS ts,"
    " CAST(CASE WHEN value < 0.5 THEN NULL ELSE value END AS FLOAT) AS reading FROM events)"
)
DAILY_SQL = "d AS (SELECT 'all' AS series, CAST(o_orderdate AS DATE) AS ds, sum(o_totalprice) AS y FROM orders GROUP BY 2)"
PRIORITY_SQL = (
    "d AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS ds, sum(o_totalprice) AS y"
    " FROM orders GROUP BY 1, 2)"
)
BASE_SQL = (
    HOURLY_SQL + ", b AS (SELECT * FROM (SELECT event_type, ts, value AS y,"
    " lag(value) OVER (PARTITION BY event_type ORDER BY ts) AS yhat FROM h) WHERE yhat IS NOT NULL)"
)
RUNS_SQL = "w(runid, start, train_end, eval_end) AS (VALUES " + ", ".join(
    f"({r.runid}, DATE '{r.start}', DATE '{r.train_end}', DATE '{r.eval_end}')" for r in RUNS
) + ")"


def _lag_sql(lags, places=6):
    names = features.lag_names("value", lags)
    cols = ", ".join(f"lag(value, {k}) OVER w AS {n}" for k, n in zip(lags, names))
    out = ", ".join(f"round({n}, {places}) AS {n}" for n in ["value", *names])
    full = " AND ".join(f"{n} IS NOT NULL" for n in ["value", *names])
    inner = f"l AS (SELECT event_type, ts, value, {cols} FROM h WINDOW w AS (PARTITION BY event_type ORDER BY ts))"
    return inner, out, full


# --------------------------------------------------------------------------- sources

@query(
    "WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders),"
    " r AS (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS ds FROM b),"
    " c AS (SELECT CAST(o_orderdate AS DATE) AS ds, count(*) AS n FROM orders GROUP BY 1)"
    " SELECT r.ds, CAST(coalesce(n, 0) AS BIGINT) AS n_orders FROM r LEFT JOIN c USING (ds)"
)
def range_calendar(spark, sf):
    """An integer range as the day grid of the orders, with the orders of each day."""
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("ds"))
    first, last = orders.agg(F.min("ds"), F.max("ds")).first()
    grid = spark.range(0, (last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("ds")
    )
    counts = orders.groupBy("ds").agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, "ds", "left").select("ds", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query(
    "SELECT 'orders' AS dataset, 'positive_price' AS expectation, count(*) FILTER (o_totalprice > 0) AS passing_records,"
    " count(*) FILTER (NOT coalesce(o_totalprice > 0, false)) AS failing_records FROM orders"
)
def catalog_scan(spark, sf):
    """A stored result read back by SQL text through the catalog."""
    checks = quality.expect(table(spark, sf, "orders"), "orders", {"positive_price": "o_totalprice > 0"})
    checks.createOrReplaceTempView("dq_results")
    return spark.sql("SELECT * FROM dq_results")


# --------------------------------------------------------------------------- projections, filters, cleaning

@query("SELECT event_type, ts, value FROM events")
def projection(spark, sf):
    return table(spark, sf, "events").select("event_type", "ts", "value")


@query("SELECT CAST(o_orderdate AS DATE) AS ds, o_totalprice AS y FROM orders")
def typed_series(spark, sf):
    """Date and value renamed and cast in one expression list."""
    raw = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("string").alias("date"), F.col("o_totalprice").cast("string").alias("price")
    )
    return raw.selectExpr("try_cast(date AS date) AS ds", "try_cast(price AS double) AS y")


@query("SELECT 1 AS runid, o_orderkey, o_totalprice FROM orders")
def constant_tag(spark, sf):
    return table(spark, sf, "orders").select(F.lit(1).alias("runid"), "o_orderkey", "o_totalprice")


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def dropped_column(spark, sf):
    return table(spark, sf, "events").drop("props")


@query("SELECT event_type AS series, ts AS ds, value AS y FROM events")
def renamed_columns(spark, sf):
    return table(spark, sf, "events").select("event_type", "ts", "value").withColumnsRenamed(
        {"event_type": "series", "ts": "ds", "value": "y"}
    )


@query("WITH " + READINGS_SQL + " SELECT event_id, ts FROM p")
def reading_timestamps(spark, sf):
    """One timestamp from date text and time text."""
    ts = parse_timestamp(F.col("Date"), F.col("Time")).cast("timestamp_ntz")
    return readings(spark, sf).select("event_id", ts.alias("ts"))


@query(
    "WITH " + READINGS_SQL + " SELECT event_type, ts, round(CAST(reading AS DOUBLE), 4) AS reading FROM p"
)
def clean_readings(spark, sf):
    """Typed panel from raw text: timestamp joined, '?' to null, decimal comma, 32-bit float."""
    out = clean.clean_readings(readings(spark, sf), SERIES, "Date", "Time", "reading")
    out = out.withColumns({"ts": F.col("ts").cast("timestamp_ntz"), "reading": F.col("reading").cast("double")})
    return rounded(out, 4, "reading")


@query(
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS y FROM orders"
)
def coerced_numbers(spark, sf):
    """Bad text becomes null instead of an error."""
    text = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", to_number(text).alias("y"))


@query(
    "SELECT o_orderkey, round(CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE), 1) AS price,"
    " CAST(o_orderdate AS DATE) AS date FROM orders"
)
def cast_columns(spark, sf):
    out = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("float").cast("double").alias("price"),
        F.col("o_orderdate").cast("date").alias("date"),
    )
    return rounded(out, 1, "price")


@query(
    "SELECT o_orderkey, o_orderdate FROM orders"
    " WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"
)
def date_range(spark, sf):
    """Closed date range; the bounds reach the scan."""
    return clean.between_dates(
        table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "1996-01-01", "1998-12-31"
    )


@query("SELECT ts, value FROM events WHERE event_type = 'click'")
def one_series(spark, sf):
    return table(spark, sf, "events").where("event_type = 'click'").select("ts", "value")


@query(
    "WITH " + READINGS_SQL + " SELECT event_id, round(CAST(reading AS DOUBLE), 4) AS reading FROM p WHERE reading IS NOT NULL"
)
def complete_readings(spark, sf):
    rows = clean.clean_readings(readings(spark, sf), ["event_id"], "Date", "Time", "reading")
    out = clean.complete_rows(rows).select("event_id", F.col("reading").cast("double").alias("reading"))
    return rounded(out, 4, "reading")


@query("SELECT event_id, value FROM events WHERE event_id NOT IN (SELECT event_id FROM events ORDER BY event_id DESC LIMIT 2)")
def without_trailer(spark, sf):
    """All rows but the last two."""
    return clean.drop_trailer(table(spark, sf, "events").select("event_id", "value"), "event_id", 2)


@query(
    "WITH " + BASE_SQL + ", l AS (SELECT event_type, ts, unnest(['yhat_lower', 'yhat', 'yhat_upper']) AS measure,"
    " unnest([yhat - 10, yhat, yhat + 10]) AS value FROM b)"
    " SELECT event_type, ts, measure, round(value, 6) + 0.0 AS value FROM l"
)
def measures_long(spark, sf):
    out = clean.to_long(baseline(spark, sf), ["event_type", "ts"], ["yhat_lower", "yhat", "yhat_upper"])
    return rounded(out, 6, "value")


def _vector_sql():
    lags, _, full = _lag_sql(features.HOURLY_LAGS)
    names = ", ".join(features.lag_names("value", features.HOURLY_LAGS))
    return (
        f"WITH {HOURLY_SQL}, {lags}, u AS (SELECT event_type, ts, unnest(range(8)) AS position, unnest([{names}]) AS feature"
        f" FROM l WHERE {full}) SELECT event_type, ts, CAST(position AS INTEGER) AS position, round(feature, 6) AS feature FROM u"
    )


@query(_vector_sql())
def feature_vectors(spark, sf):
    """Lag columns assembled into one ML vector, one row per vector entry."""
    from pyspark.ml.functions import vector_to_array

    names = features.lag_names("value", features.HOURLY_LAGS)
    out = features.feature_vector(lagged(spark, sf), names)
    entries = F.posexplode(vector_to_array("features")).alias("position", "feature")
    return rounded(out.select("event_type", "ts", entries), 6, "feature")


# --------------------------------------------------------------------------- resampling, lags, smoothing

@query("WITH " + HOURLY_SQL + " SELECT event_type, ts, round(value, 6) AS value FROM h")
def hourly_mean(spark, sf):
    return rounded(hourly(spark, sf), 6, "value")


@query(
    "WITH " + READINGS_SQL + " SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00:00') AS hour,"
    " round(avg(CAST(reading AS DOUBLE)), 5) AS reading, count(*) AS n FROM p GROUP BY 1, 2"
)
def hourly_from_text(spark, sf):
    """Raw text to hourly means, the hour in its text form."""
    panel = clean.clean_readings(readings(spark, sf), SERIES, "Date", "Time", "reading")
    hours = resample(
        panel, SERIES, "ts", {"reading": F.avg(F.col("reading").cast("double")), "n": F.count(F.lit(1))}, "hour"
    )
    out = hours.select("event_type", F.date_format("ts", "yyyy-MM-dd HH:00:00").alias("hour"), "reading", "n")
    return rounded(out, 5, "reading")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT 'all' AS event_type, count(*) AS n FROM events")
def row_counts(spark, sf):
    by_series = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    total = by_series.agg(F.lit("all").alias("event_type"), F.sum("n").alias("n"))
    return by_series.unionByName(total)


_LAGS, _LAG_OUT, _LAG_FULL = _lag_sql(features.HOURLY_LAGS)


@query(f"WITH {HOURLY_SQL}, {_LAGS} SELECT event_type, ts, {_LAG_OUT} FROM l")
def lag_columns(spark, sf):
    out = features.lag_features(hourly(spark, sf), SERIES, "ts", "value")
    return rounded(out, 6, *out.columns[2:])


@query(f"WITH {HOURLY_SQL}, {_LAGS} SELECT event_type, ts, {_LAG_OUT} FROM l WHERE {_LAG_FULL}")
def hourly_lags(spark, sf):
    """Hourly means with eight lags, complete rows only: the training table."""
    out = lagged(spark, sf)
    return rounded(out, 6, *out.columns[2:])


_DAY_LAGS = (1, 2, 3)
_DLAGS, _DLAG_OUT, _DLAG_FULL = _lag_sql(_DAY_LAGS)


@query(
    "WITH h AS (SELECT user_id AS event_type, date_trunc('day', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2),"
    f" {_DLAGS} SELECT event_type AS user_id, CAST(ts AS TIMESTAMP) AS ts, {_DLAG_OUT} FROM l WHERE {_DLAG_FULL}"
)
def user_daily_lags(spark, sf):
    """Many short series: daily means per user with three lags."""
    days = resample(table(spark, sf, "events"), ["user_id"], "ts", "value", "day")
    out = features.lag_table(days, ["user_id"], "ts", "value", _DAY_LAGS)
    return rounded(out, 6, *out.columns[2:])


@query(
    "WITH l AS (SELECT event_id, event_type, lag(value, 1) OVER w AS value_lag1, lag(value, 24) OVER w AS value_lag24"
    " FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)) SELECT * FROM l"
)
def raw_lags_blocked(spark, sf):
    """Lags on raw events. Series are cut into chunks that overlap by the longest lag, so a
    series of any length never sits in one task."""
    raw = table(spark, sf, "events").select(
        "event_id", "event_type", F.struct("ts", "event_id").alias("at"), "value"
    )
    out = features.lag_features(
        raw, SERIES, "at", "value", (1, 24), block=F.date_trunc("hour", F.col("at.ts")), chunk_rows=10_000
    )
    return out.select("event_id", "event_type", "value_lag1", "value_lag24")


EMA_SQL = (
    "r AS (SELECT event_type, ts, value, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn FROM h),"
    " e AS (SELECT event_type, ts, rn, value, value AS ema FROM r WHERE rn = 1 UNION ALL"
    " SELECT r.event_type, r.ts, r.rn, r.value, 0.1 * r.value + 0.9 * e.ema FROM e JOIN r"
    " ON r.event_type = e.event_type AND r.rn = e.rn + 1)"
)


@query("WITH RECURSIVE " + HOURLY_SQL + ", " + EMA_SQL + " SELECT event_type, ts, round(ema, 6) AS ema FROM e")
def exponential_average(spark, sf):
    out = features.ema(hourly(spark, sf), SERIES, "ts", "value", alpha=0.1)
    return rounded(out.select("event_type", "ts", "ema"), 6, "ema")


@query(
    "WITH " + PRIORITY_SQL + " SELECT series, ds, round(avg(y) OVER (PARTITION BY series ORDER BY ds"
    " ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 3) AS smooth FROM d"
)
def moving_average(spark, sf):
    out = features.moving_average(daily_by_priority(spark, sf), ["series"], "ds", "y", width=5)
    return rounded(out.select("series", "ds", "smooth"), 3, "smooth")


# --------------------------------------------------------------------------- splits and folds

@query(
    "WITH " + HOURLY_SQL + " SELECT event_type, ts, CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) <= 48"
    " THEN 'test' ELSE 'train' END AS part FROM h"
)
def holdout_last_rows(spark, sf):
    return splits.holdout_last(hourly(spark, sf), SERIES, "ts", 48).select("event_type", "ts", "part")


@query(
    "WITH l AS (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)"
    " SELECT event_id, CASE WHEN rn <= 48 THEN 'test' ELSE 'train' END AS part FROM l"
)
def holdout_raw_blocked(spark, sf):
    """The same hold-out on raw events, ranked by hour blocks."""
    raw = table(spark, sf, "events").select("event_id", "event_type", F.struct("ts", "event_id").alias("at"))
    out = splits.holdout_last(raw, SERIES, "at", 48, block=F.date_trunc("hour", F.col("at.ts")))
    return out.select("event_id", "part")


@query(
    "WITH " + HOURLY_SQL + ", r AS (SELECT event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn,"
    " count(*) OVER (PARTITION BY event_type) AS n FROM h)"
    " SELECT event_type, ts, CASE WHEN rn > n - ceil(n * 0.2) THEN 'test' ELSE 'train' END AS part FROM r"
)
def holdout_last_fraction(spark, sf):
    return splits.holdout_fraction(hourly(spark, sf), SERIES, "ts", 0.2).select("event_type", "ts", "part")


@query(
    "WITH " + HOURLY_SQL + ", r AS (SELECT event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn,"
    " count(*) OVER (PARTITION BY event_type) AS n FROM h), f AS (SELECT unnest(range(10)) AS fold),"
    " x AS (SELECT r.*, CAST(fold AS INTEGER) AS fold, n // 11 AS size FROM r, f)"
    " SELECT event_type, ts, fold, CASE WHEN rn <= n - (10 - fold) * size THEN 'train' ELSE 'test' END AS role"
    " FROM x WHERE rn <= n - (10 - fold) * size + size"
)
def expanding_folds(spark, sf):
    out = splits.time_series_folds(hourly(spark, sf), SERIES, "ts", 10)
    return out.select("event_type", "ts", "fold", "role")


CUTOFF_SQL = (
    "b AS (SELECT series, min(ds) AS a, max(ds) AS z FROM d GROUP BY 1),"
    " c AS (SELECT series, CAST(z - 90 - 30 * j AS DATE) AS cutoff FROM b, (SELECT CAST(unnest(range(200)) AS INTEGER) AS j)"
    " WHERE z - 90 - 30 * j >= a + 700)"
)


@query("WITH " + PRIORITY_SQL + ", " + CUTOFF_SQL + " SELECT series, cutoff FROM c")
def cutoff_days(spark, sf):
    return splits.cutoffs(daily_by_priority(spark, sf), ["series"], "ds")


@query(
    "WITH " + PRIORITY_SQL + ", " + CUTOFF_SQL + " SELECT d.series, ds, cutoff, CASE WHEN ds <= cutoff THEN 'train' ELSE 'test' END AS role"
    " FROM d JOIN c ON d.series = c.series AND ds <= cutoff + 90"
)
def cutoff_fold_rows(spark, sf):
    out = splits.cutoff_folds(daily_by_priority(spark, sf), ["series"], "ds", value="y")
    return out.select("series", "ds", "cutoff", "role")


@query(
    "WITH " + BASE_SQL + ", r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS back FROM b)"
    " SELECT event_type, ts, round(y, 6) AS value, CASE WHEN back <= 48 THEN 'test' ELSE 'train' END AS part FROM r WHERE back <= 198"
    " UNION ALL SELECT event_type, ts, round(yhat, 6) AS value, 'forecast' AS part FROM r WHERE back <= 48"
)
def chart_rows(spark, sf):
    """Last 150 train rows, the test rows and their forecasts in one frame."""
    rows = baseline(spark, sf)
    test = splits.holdout_last(rows, SERIES, "ts", 48).where("part = 'test'")
    return rounded(splits.chart_frame(rows, SERIES, "ts", "y", test, recent=150, test=48), 6, "value")


# --------------------------------------------------------------------------- sorts, top rows, set operations

@query("SELECT event_type, ts, value FROM events ORDER BY event_type, ts")
def sorted_panel(spark, sf):
    return table(spark, sf, "events").select("event_type", "ts", "value").orderBy("event_type", "ts")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def preview_rows(spark, sf):
    """First rows of a sorted table, as a preview shows them."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "SELECT 'all' AS series, date_trunc('hour', ts) AS ts, count(*) AS n FROM events GROUP BY 2"
    " UNION ALL SELECT event_type AS series, date_trunc('hour', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2"
)
def panel_union(spark, sf):
    """The overall series appended to the per-type series."""
    count = {"n": F.count(F.lit(1))}
    by_type = resample(table(spark, sf, "events"), SERIES, "ts", count).withColumnRenamed("event_type", "series")
    # The overall counts come from the per-type ones: the raw table is read once.
    total = by_type.groupBy("ts").agg(F.sum("n").alias("n")).withColumn("series", F.lit("all"))
    return by_type.unionByName(total)


@query(
    "WITH " + DAILY_SQL + ", " + RUNS_SQL + " SELECT runid, ds, round(y, 2) AS y FROM d JOIN w ON ds BETWEEN start AND train_end"
)
def stacked_runs(spark, sf):
    """The same layer of five runs, tagged and stacked."""
    days = daily(spark, sf)
    parts = {r.runid: clean.between_dates(days, "ds", r.start, r.train_end) for r in RUNS}
    return rounded(layer_io.stack_layers(parts), 2, "y").select("runid", "ds", "y")


# --------------------------------------------------------------------------- scoring

_ERR = {
    "mse": "avg((y - yhat) * (y - yhat))",
    "rmse": "sqrt(avg((y - yhat) * (y - yhat)))",
    "mae": "avg(abs(y - yhat))",
    "mape": "avg(abs(y - yhat) / greatest(abs(y), 2.220446049250313e-16))",
    "smape": "avg(CASE WHEN y = 0 AND yhat = 0 THEN 0 ELSE abs(y - yhat) / ((abs(y) + abs(yhat)) / 2) END)",
    "wape": "sum(abs(y - yhat)) / sum(abs(y))",
    "mdape": "median(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END)",
    "coverage": "avg(CASE WHEN y BETWEEN yhat_lower AND yhat_upper THEN 1.0 ELSE 0.0 END)",
    "r2": "1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*))",
    "mean_error": "avg(y - yhat)",
    "max_error": "max(abs(y - yhat))",
}


def _err_sql(names, places=6):
    return ", ".join(f"round({_ERR[n]}, {places}) + 0.0 AS {n}" for n in names)


_SCORES = ("mse", "rmse", "mae", "mape", "smape", "wape", "mdape", "coverage")
_BAND_SQL = BASE_SQL + ", s AS (SELECT *, yhat - 10 AS yhat_lower, yhat + 10 AS yhat_upper FROM b)"


@query(f"WITH {_BAND_SQL} SELECT event_type, count(*) AS n_rows, {_err_sql(_SCORES)} FROM s GROUP BY 1")
def forecast_scores(spark, sf):
    """All eight measures per series."""
    return rounded(metrics.score(baseline(spark, sf), "y", "yhat", SERIES, _SCORES), 6, *_SCORES)


@query(f"WITH {_BAND_SQL} SELECT count(*) AS n_rows, {_err_sql(_SCORES)} FROM s")
def forecast_scores_overall(spark, sf):
    """The same measures over all rows."""
    return rounded(metrics.score(baseline(spark, sf), "y", "yhat", [], _SCORES), 6, *_SCORES)


_LONG = [m for m in metrics.ALL_METRICS if m != "coverage"]


@query(
    f"WITH {_BAND_SQL}, t AS (SELECT event_type, {_err_sql(_LONG)} FROM s GROUP BY 1)"
    f" SELECT event_type, metric, value FROM t UNPIVOT INCLUDE NULLS (value FOR metric IN ({', '.join(_LONG)}))"
)
def all_metrics_long(spark, sf):
    return rounded(metrics.all_metrics(baseline(spark, sf), "y", "yhat", SERIES), 6, "value")


@query(f"WITH {_BAND_SQL}, t AS (SELECT event_type, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse FROM s GROUP BY 1)"
       " SELECT round(avg(mae), 6) AS mae, round(avg(rmse), 6) AS rmse FROM t")
def mean_metrics(spark, sf):
    """Each measure averaged over the scored groups."""
    per_series = metrics.score(baseline(spark, sf), "y", "yhat", SERIES, ["mae", "rmse"])
    return rounded(metrics.mean_over_horizons(per_series, [], ["mae", "rmse"]), 6, "mae", "rmse")


# --------------------------------------------------------------------------- additive forecasts

_Z = forecast.interval_z()


def _trend_sql(by: str, train: str, out: str = "") -> str:
    """Trend-plus-season fit of the rows of `train` by the key columns `by`, in plain SQL."""
    keys = ", ".join(f"x.{k}" for k in by.split(", "))
    return (
        f"x AS (SELECT *, date_diff('day', DATE '2000-01-01', ds) AS t, dayofweek(ds) AS dow FROM {train}),"
        f" m AS (SELECT {by}, regr_slope(y, t) AS b, regr_intercept(y, t) AS a, max(ds) AS last_ds FROM x GROUP BY {by}),"
        f" s AS (SELECT {keys}, dow, avg(y - a - b * t) AS off FROM x JOIN m USING ({by}) GROUP BY {keys}, dow),"
        f" v AS (SELECT {keys}, stddev_samp(y - a - b * t - off) AS sd FROM x JOIN m USING ({by}) JOIN s USING ({by}, dow) GROUP BY {keys}),"
        f" q AS (SELECT m.*, sd FROM m JOIN v USING ({by}))"
    )


def _yhat_sql(p: str = "p") -> str:
    return (
        f"a + b * date_diff('day', DATE '2000-01-01', {p}.ds) + coalesce(off, 0)"
    )


_BAND_OUT = (
    f"round(yhat, 3) + 0.0 AS yhat, round(yhat - {_Z!r} * sd, 3) + 0.0 AS yhat_lower, round(yhat + {_Z!r} * sd, 3) + 0.0 AS yhat_upper"
)


@query(
    "WITH " + PRIORITY_SQL + ", " + _trend_sql("series", "d") +
    ", p AS (SELECT series, CAST(last_ds + CAST(i AS INTEGER) AS DATE) AS ds FROM m, (SELECT unnest(range(1, 366)) AS i)),"
    f" y AS (SELECT p.series, p.ds, {_yhat_sql()} AS yhat, sd FROM p JOIN q USING (series)"
    " LEFT JOIN s ON s.series = p.series AND s.dow = dayofweek(p.ds))"
    f" SELECT series, ds, {_BAND_OUT} FROM y"
)
def additive_forecast(spark, sf):
    """A year ahead for every series: trend, day-of-week offsets and an interval."""
    out = forecast.additive_forecast(daily_by_priority(spark, sf), ["series"], horizon=365)
    return rounded(out, 3, "yhat", "yhat_lower", "yhat_upper")


@query(
    "WITH " + PRIORITY_SQL + ", " + _trend_sql("series", "d") +
    ", e AS (SELECT series, min(ds) AS a0, max(ds) + 30 AS z0 FROM d GROUP BY 1),"
    " p AS (SELECT series, CAST(unnest(generate_series(CAST(a0 AS TIMESTAMP), CAST(z0 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS ds FROM e),"
    f" y AS (SELECT p.series, p.ds, {_yhat_sql()} AS yhat, sd FROM p JOIN q USING (series)"
    " LEFT JOIN s ON s.series = p.series AND s.dow = dayofweek(p.ds))"
    f" SELECT series, ds, {_BAND_OUT} FROM y"
)
def forecast_with_history(spark, sf):
    """History and 30 days ahead."""
    out = forecast.additive_forecast(daily_by_priority(spark, sf), ["series"], horizon=30, include_history=True)
    return rounded(out, 3, "yhat", "yhat_lower", "yhat_upper")


@query()
def additive_ridge_forecast(spark, sf):
    """Piecewise trend with yearly and weekly waves, 30 days ahead, per series."""
    out = forecast.additive_forecast(daily_by_priority(spark, sf), ["series"], horizon=30, model="ridge")
    return rounded(out, 2, "yhat", "yhat_lower", "yhat_upper")


@query(
    "WITH " + PRIORITY_SQL + " SELECT series, CAST(30 AS BIGINT) AS n_rows, true AS close, true AS inside FROM d GROUP BY series"
)
def additive_ridge_known_series(spark, sf):
    """A line with a weekly and a yearly wave on the days of each series, forecast 30 days ahead:
    the forecast must be near the known values and the known values inside its interval."""
    day = F.datediff(F.col("ds"), F.lit("2000-01-01").cast("date"))
    known = 100 + 0.01 * day + 5 * F.sin(day * (2 * math.pi / 7)) + 8 * F.cos(day * (2 * math.pi / 365.25))
    series = daily_by_priority(spark, sf).select("series", "ds", known.alias("y"))
    out = forecast.additive_forecast(series, ["series"], horizon=30, model="ridge").withColumn("known", known)
    return out.groupBy("series").agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.max(F.abs(F.col("yhat") - F.col("known"))) < 0.5).alias("close"),
        F.bool_and(F.abs(F.col("known") - F.col("yhat")) <= F.col("yhat_upper") - F.col("yhat") + 0.5).alias("inside"),
    )


@query(
    "WITH " + DAILY_SQL + ", x AS (SELECT ds, y, CAST(date_diff('day', DATE '1970-01-01', ds) AS DOUBLE) AS t FROM d),"
    " r AS (SELECT *, row_number() OVER (ORDER BY t, y) AS rn FROM x),"
    " n AS (SELECT a.rn, a.ds, a.t AS t0, b.t, b.y, abs(b.t - a.t) AS dist FROM r a JOIN r b ON b.rn BETWEEN a.rn - 29 AND a.rn + 29"
    " QUALIFY row_number() OVER (PARTITION BY a.rn ORDER BY abs(b.t - a.t), b.t, b.y) <= 30),"
    " w AS (SELECT *, pow(1 - pow(dist / max(dist) OVER (PARTITION BY rn), 3), 3) AS w FROM n),"
    " m AS (SELECT rn, ds, t0, sum(w * t) / sum(w) AS mt, sum(w * y) / sum(w) AS my FROM w GROUP BY 1, 2, 3)"
    " SELECT m.ds, round(any_value(my) + sum(w * (t - mt) * (y - my)) / sum(w * (t - mt) * (t - mt)) * any_value(m.t0 - mt), 3) + 0.0 AS smooth"
    " FROM w JOIN m USING (rn) GROUP BY m.rn, m.ds"
)
def smoothed_series(spark, sf):
    """Locally weighted line through the 30 nearest days of each day."""
    return rounded(smoothing.local_regression(daily(spark, sf), [], "ds", "y", 30), 3, "smooth").select("ds", "smooth")


_CV_SQL = (
    DAILY_SQL + ", " + CUTOFF_SQL
    + ", tr AS (SELECT d.series, cutoff, ds, y FROM d JOIN c ON d.series = c.series AND ds <= cutoff), "
    + _trend_sql("series, cutoff", "tr")
    + ", p AS (SELECT d.series, cutoff, ds, y FROM d JOIN c ON d.series = c.series AND ds > cutoff AND ds <= cutoff + 90),"
    + f" yy AS (SELECT p.series, p.cutoff, p.ds, p.y, {_yhat_sql()} AS yhat, sd FROM p JOIN q USING (series, cutoff)"
    + " LEFT JOIN s ON s.series = p.series AND s.cutoff = p.cutoff AND s.dow = dayofweek(p.ds)),"
    + f" z AS (SELECT *, yhat - {_Z!r} * sd AS yhat_lower, yhat + {_Z!r} * sd AS yhat_upper,"
    + " date_diff('day', cutoff, ds) AS horizon FROM yy)"
)


@query(
    f"WITH {_CV_SQL} SELECT cutoff, ds, round(y, 2) + 0.0 AS y, round(yhat, 3) + 0.0 AS yhat,"
    " round(yhat_lower, 3) + 0.0 AS yhat_lower, round(yhat_upper, 3) + 0.0 AS yhat_upper FROM z"
)
def rolling_origin(spark, sf):
    """Forecasts of every cutoff (700 days first, every 30 days, 90 days ahead)."""
    out = rounded(forecast.rolling_origin(daily(spark, sf), []), 3, "yhat", "yhat_lower", "yhat_upper")
    return rounded(out, 2, "y")


_CV = metrics.HORIZON_METRICS
_CV_PLACES = {"mse": 0, "rmse": 2, "mae": 2, "mdape": 6, "smape": 6, "coverage": 6}


def _cv_out(alias=""):
    return ", ".join(f"round({_ERR[n]}, {_CV_PLACES[n]}) + 0.0 AS {n}" for n in _CV)


@query(
    f"WITH {_CV_SQL}, g AS (SELECT CAST(unnest(range(9, 91)) AS INTEGER) AS ahead),"
    f" k AS (SELECT ahead AS horizon, y, yhat, yhat_lower, yhat_upper FROM z JOIN g ON z.horizon BETWEEN ahead - 8 AND ahead)"
    f" SELECT CAST(horizon AS INTEGER) AS horizon, count(*) AS n_rows, {_cv_out()} FROM k GROUP BY 1"
)
def scores_by_horizon(spark, sf):
    """Measures by days ahead, rolling over nine horizons."""
    rows = forecast.rolling_origin(daily(spark, sf), [])
    # One series: a horizon has at most (cutoffs x window) rows, so its median fits a task.
    out = metrics.score_by_horizon(rows, "y", "yhat", "ds", window=9, horizon=90, metrics=_CV, median="grouped")
    return out.withColumns({n: F.round(n, _CV_PLACES[n]) + F.lit(0.0) for n in _CV})


@query(
    f"WITH {_CV_SQL}, g AS (SELECT CAST(unnest(range(9, 91)) AS INTEGER) AS ahead),"
    " o AS (SELECT ahead AS horizon, y, yhat, yhat_lower, yhat_upper FROM z JOIN g ON z.horizon BETWEEN ahead - 8 AND ahead),"
    f" k AS (SELECT horizon, {', '.join(f'{_ERR[n]} AS {n}' for n in _CV)} FROM o GROUP BY 1)"
    f" SELECT {', '.join(f'round(avg({n}), {_CV_PLACES[n]}) + 0.0 AS {n}' for n in _CV)} FROM k"
)
def cross_validation_metrics(spark, sf):
    """Mean of each measure over the horizons, each rolling over nine of the 90 days."""
    rows = forecast.rolling_origin(daily(spark, sf), [])
    per_day = metrics.score_by_horizon(rows, "y", "yhat", "ds", window=9, horizon=90, metrics=_CV, median="grouped")
    out = metrics.mean_over_horizons(per_day, [], _CV)
    return out.withColumns({n: F.round(n, _CV_PLACES[n]) + F.lit(0.0) for n in _CV})


_PANEL_CV_SQL = _CV_SQL.replace(DAILY_SQL, PRIORITY_SQL)


@query(
    f"WITH {_PANEL_CV_SQL} SELECT CAST(horizon AS INTEGER) AS horizon, count(*) AS n_rows, {_cv_out()} FROM z GROUP BY 1"
)
def panel_scores_by_horizon(spark, sf):
    """Measures per horizon over all series of a panel; medians of groups of any size."""
    rows = forecast.rolling_origin(daily_by_priority(spark, sf), ["series"])
    out = metrics.score_by_horizon(rows, "y", "yhat", "ds", metrics=_CV)
    return out.withColumns({n: F.round(n, _CV_PLACES[n]) + F.lit(0.0) for n in _CV})


# --------------------------------------------------------------------------- backtest

@query(
    "WITH " + DAILY_SQL + ", " + RUNS_SQL + " SELECT runid, ds, round(y, 2) AS y,"
    " CASE WHEN ds <= train_end THEN 'train' ELSE 'eval' END AS part FROM d JOIN w ON ds BETWEEN start AND eval_end"
)
def run_window_rows(spark, sf):
    """Days assigned to the train and eval windows of all runs at once."""
    out = backtest.assign_runs(daily(spark, sf), "ds", RUNS)
    return rounded(out.select("runid", "ds", "y", "part"), 2, "y")


@query(
    "WITH " + RUNS_SQL + " SELECT runid, o_orderkey, o_orderdate FROM orders JOIN w"
    " ON CAST(o_orderdate AS DATE) BETWEEN start AND train_end"
)
def bronze_train(spark, sf):
    """Raw orders of every run's train window."""
    raw = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return layers.bronze(raw, "o_orderdate", RUNS, "train").select("runid", "o_orderkey", "o_orderdate")


@query(
    "WITH " + RUNS_SQL + " SELECT runid, CAST(o_orderdate AS DATE) AS ds, o_totalprice AS y FROM orders JOIN w"
    " ON CAST(o_orderdate AS DATE) > train_end AND CAST(o_orderdate AS DATE) <= eval_end"
)
def silver_eval(spark, sf):
    """Typed complete rows of every run's evaluation window."""
    raw = table(spark, sf, "orders").select("o_orderdate", F.col("o_totalprice").cast("string").alias("price"))
    return layers.silver(layers.bronze(raw, "o_orderdate", RUNS, "eval"), "o_orderdate", "price")


_RUN_FIT = (
    DAILY_SQL + ", " + RUNS_SQL
    + ", tr AS (SELECT runid, ds, y FROM d JOIN w ON ds BETWEEN start AND train_end), "
    + _trend_sql("runid", "tr")
    + ", p AS (SELECT runid, CAST(unnest(generate_series(CAST(last_ds + 1 AS TIMESTAMP), CAST(eval_end AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS ds"
    + " FROM m JOIN w USING (runid)),"
    + f" y AS (SELECT p.runid, p.ds, {_yhat_sql()} AS yhat, sd FROM p JOIN q USING (runid)"
    + " LEFT JOIN s ON s.runid = p.runid AND s.dow = dayofweek(p.ds))"
)
_RUN_JOIN = (
    _RUN_FIT
    + ", j AS (SELECT y.runid, y.ds, yhat, sd, d.y AS y FROM y JOIN w USING (runid) JOIN d ON d.ds = y.ds AND d.ds > train_end)"
)


@query(f"WITH {_RUN_FIT} SELECT runid, ds, {_BAND_OUT} FROM y")
def gold_forecast(spark, sf):
    """Forecast layer of all runs."""
    out = backtest.walk_forward_forecast(daily(spark, sf), RUNS)
    return rounded(out, 3, "yhat", "yhat_lower", "yhat_upper")


@query(f"WITH {_RUN_JOIN} SELECT runid, count(*) AS n_rows, round(sqrt(avg((y - yhat) * (y - yhat))), 2) AS rmse FROM j GROUP BY 1")
def walk_forward(spark, sf):
    """Five yearly runs in one job: train, forecast, join with actuals, RMSE per run."""
    return rounded(backtest.walk_forward(daily(spark, sf), RUNS), 2, "rmse")


@query(
    "WITH dp AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS ds, sum(o_totalprice) AS y FROM orders GROUP BY 1, 2), "
    + RUNS_SQL + ", tr AS (SELECT runid, series, ds, y FROM dp JOIN w ON ds BETWEEN start AND train_end), "
    + _trend_sql("runid, series", "tr")
    + ", p AS (SELECT runid, series, ds, y FROM dp JOIN w ON ds > train_end AND ds <= eval_end),"
    + f" j AS (SELECT p.runid, p.series, p.y, {_yhat_sql()} AS yhat FROM p JOIN q USING (runid, series)"
    + " LEFT JOIN s ON s.runid = p.runid AND s.series = p.series AND s.dow = dayofweek(p.ds) WHERE p.ds > q.last_ds)"
    + " SELECT runid, series, count(*) AS n_rows, round(sqrt(avg((y - yhat) * (y - yhat))), 2) AS rmse FROM j GROUP BY 1, 2"
)
def walk_forward_panel(spark, sf):
    """The same runs for every series of a panel, still one job."""
    return rounded(backtest.walk_forward(daily_by_priority(spark, sf), RUNS, ["series"]), 2, "rmse")


def _run_actuals(spark, sf, runs=RUNS):
    return (
        backtest.assign_runs(daily(spark, sf), "ds", runs).where("part = 'eval'").select("runid", "ds", "y")
    )


@query(
    f"WITH {_RUN_JOIN} SELECT runid, ds AS date, {_BAND_OUT}, round(y, 2) AS y FROM j"
)
def compare_runs(spark, sf):
    """Forecasts next to actuals, per run and date, in that order."""
    out = backtest.compare_runs(backtest.walk_forward_forecast(daily(spark, sf), RUNS), _run_actuals(spark, sf))
    return rounded(rounded(out, 3, "yhat", "yhat_lower", "yhat_upper"), 2, "y").orderBy("runid", "date")


@query(
    f"WITH {_RUN_JOIN} SELECT runid, count(*) AS eval_forecast_count, round(sqrt(avg((y - yhat) * (y - yhat))), 2) AS eval_rmse FROM j GROUP BY runid"
)
def evaluate_one_run(spark, sf):
    """Join, completeness, count and RMSE of each run's stored forecast."""
    forecasts = backtest.walk_forward_forecast(daily(spark, sf), RUNS)
    rows = backtest.evaluation_rows(_run_actuals(spark, sf), forecasts, ["runid", "ds"])
    out = metrics.score(rows, "y", "yhat", ["runid"], ["rmse"])
    return rounded(out.withColumnsRenamed({"n_rows": "eval_forecast_count", "rmse": "eval_rmse"}), 2, "eval_rmse")


@query(
    f"WITH {_RUN_JOIN}, l AS (SELECT runid, ds AS date, unnest(['yhat_lower', 'yhat', 'yhat_upper', 'y']) AS measure,"
    f" unnest([yhat - {_Z!r} * sd, yhat, yhat + {_Z!r} * sd, y]) AS value FROM j)"
    " SELECT runid, date, measure, round(value, 3) + 0.0 AS value FROM l"
)
def forecast_band_long(spark, sf):
    """Band and actuals in long form for one chart."""
    wide = backtest.compare_runs(backtest.walk_forward_forecast(daily(spark, sf), RUNS), _run_actuals(spark, sf))
    return rounded(clean.to_long(wide, ["runid", "date"], ["yhat_lower", "yhat", "yhat_upper", "y"]), 3, "value")


@query(
    f"WITH {_RUN_JOIN} SELECT 'walk_forward' AS experiment, CAST(runid AS VARCHAR) AS run_id, CAST(count(*) AS VARCHAR) AS eval_forecast_count,"
    " CAST(CAST(round(sqrt(avg((y - yhat) * (y - yhat)))) AS BIGINT) AS VARCHAR) AS eval_rmse FROM j GROUP BY runid"
)
def run_log(spark, sf):
    """Run records in long form, pivoted back to one row per run."""
    scores = backtest.walk_forward(daily(spark, sf), RUNS).select(
        "runid", F.col("n_rows").alias("eval_forecast_count"), F.round("rmse").cast("long").alias("eval_rmse")
    )
    names = ["eval_forecast_count", "eval_rmse"]
    return registry.run_table(registry.long_runs(scores, "walk_forward", "runid", metrics=names), names)


# --------------------------------------------------------------------------- models per series

TWO_LAGS = (1, 24)
TWO = features.lag_names("value", TWO_LAGS)
EIGHT = features.lag_names("value", features.HOURLY_LAGS)


def two_lags(spark, sf):
    return lagged(spark, sf, TWO_LAGS)


_TWO_SQL = (
    HOURLY_SQL + ", l0 AS (SELECT event_type, ts, value AS y, lag(value, 1) OVER w AS x1, lag(value, 24) OVER w AS x2"
    " FROM h WINDOW w AS (PARTITION BY event_type ORDER BY ts)),"
    " l AS (SELECT * FROM l0 WHERE x1 IS NOT NULL AND x2 IS NOT NULL),"
    " r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM l),"
    " pt AS (SELECT *, CASE WHEN rn > n - ceil(n * 0.2) THEN 'test' ELSE 'train' END AS part FROM r)"
)


def _solve_sql(source: str, by: str, l2: str = "1.0", lags: str = "2") -> str:
    """Closed form of the two-feature ridge from centred sums c11, c12, c22, c1y, c2y."""
    w1 = (
        f"CASE WHEN {lags} = 1 THEN c1y / (c11 + {l2}) ELSE"
        f" ((c22 + {l2}) * c1y - c12 * c2y) / ((c11 + {l2}) * (c22 + {l2}) - c12 * c12) END"
    )
    w2 = (
        f"CASE WHEN {lags} = 1 THEN 0 ELSE"
        f" ((c11 + {l2}) * c2y - c12 * c1y) / ((c11 + {l2}) * (c22 + {l2}) - c12 * c12) END"
    )
    return (
        f"SELECT *, my - w1 * m1 - w2 * m2 AS w0 FROM (SELECT *, {w1} AS w1, {w2} AS w2 FROM {source})"
    )


def _centred_sql(source: str, by: str) -> str:
    return (
        f"SELECT {by}, count(*) AS k, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my,"
        " var_pop(x1) * count(*) AS c11, var_pop(x2) * count(*) AS c22, covar_pop(x1, x2) * count(*) AS c12,"
        f" covar_pop(x1, y) * count(*) AS c1y, covar_pop(x2, y) * count(*) AS c2y FROM {source} GROUP BY {by}"
    )


@query(
    f"WITH {_TWO_SQL}, c AS ({_centred_sql('(SELECT * FROM pt WHERE part = ' + chr(39) + 'train' + chr(39) + ')', 'event_type')}),"
    f" m AS ({_solve_sql('c', 'event_type')}),"
    " e AS (SELECT event_type, y, w0 + w1 * x1 + w2 * x2 AS yhat FROM pt JOIN m USING (event_type) WHERE part = 'test')"
    f" SELECT event_type, count(*) AS n_rows, {_err_sql(['rmse', 'mape'])} FROM e GROUP BY 1"
)
def series_model_scores(spark, sf):
    """One ridge model per series on two lags, scored on the last fifth."""
    out = models.per_series_scores(two_lags(spark, sf), SERIES, "ts", TWO, "value", l2=1.0)
    return rounded(out, 6, "rmse", "mape")


_LAG8_SQL = (
    HOURLY_SQL + ", l0 AS (SELECT event_type, ts, value AS y, "
    + ", ".join(f"lag(value, {k}) OVER w AS x{i}" for i, k in enumerate(features.HOURLY_LAGS))
    + " FROM h WINDOW w AS (PARTITION BY event_type ORDER BY ts)),"
    " l AS (SELECT * FROM l0 WHERE " + " AND ".join(f"x{i} IS NOT NULL" for i in range(len(features.HOURLY_LAGS))) + "),"
    " r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM l),"
    " pt AS (SELECT *, CASE WHEN rn > n - ceil(n * 0.2) THEN 'test' ELSE 'train' END AS part FROM r)"
)


def _centred_wide_sql(source: str, by: str, d: int) -> str:
    """Means m0.. and my, and centred sums a_i_j and a_i_d (with y), of d features per group."""
    cols = [f"x{i}" for i in range(d)] + ["y"]
    sums = [f"covar_pop({cols[i]}, {cols[j]}) * count(*) AS c_{i}_{j}" for i in range(d) for j in range(i, d + 1)]
    means = [f"avg(x{i}) AS m{i}" for i in range(d)] + ["avg(y) AS my"]
    return f"SELECT {by}, {', '.join(means + sums)} FROM {source} GROUP BY {by}"


def _eliminated_sql(source: str, d: int, l2: str = "1.0", used: str | None = None) -> str:
    """Weights w0.. and intercept b of the ridge on the first `used` features, by elimination on
    the centred sums of `source`."""
    used = used or str(d)
    start = [
        f"CASE WHEN {max(i, j if j < d else 0)} < {used} THEN c_{i}_{j}{f' + {l2}' if i == j else ''} ELSE {1.0 if i == j else 0.0} END AS a_{i}_{j}"
        for i in range(d) for j in range(i, d + 1)
    ]
    out = f"SELECT *, {', '.join(start)} FROM {source}"
    for k in range(d - 1):
        steps = [f"a_{i}_{j} - a_{k}_{i} * a_{k}_{j} / a_{k}_{k} AS a_{i}_{j}" for i in range(k + 1, d) for j in range(i, d + 1)]
        out = f"SELECT * REPLACE ({', '.join(steps)}) FROM ({out})"
    for i in reversed(range(d)):
        known = "".join(f" - a_{i}_{j} * w{j}" for j in range(i + 1, d))
        out = f"SELECT *, (a_{i}_{d}{known}) / a_{i}_{i} AS w{i} FROM ({out})"
    return f"SELECT *, my{''.join(f' - w{i} * m{i}' for i in range(d))} AS b FROM ({out})"


_D8 = len(features.HOURLY_LAGS)
_YHAT8 = "b" + "".join(f" + w{i} * x{i}" for i in range(_D8))


@query(
    f"WITH {_LAG8_SQL}, c AS ({_centred_wide_sql(chr(40) + 'SELECT * FROM pt WHERE part = ' + chr(39) + 'train' + chr(39) + chr(41), 'event_type', _D8)}),"
    f" m AS ({_eliminated_sql('c', _D8)}),"
    f" e AS (SELECT event_type, y, {_YHAT8} AS yhat FROM pt JOIN m USING (event_type) WHERE part = 'test')"
    f" SELECT event_type, count(*) AS n_rows, {_err_sql(['rmse', 'mape'])} FROM e GROUP BY 1"
)
def series_model_scores_eight_lags(spark, sf):
    """The same with the eight lags of the hourly panel."""
    out = models.per_series_scores(lagged(spark, sf), SERIES, "ts", EIGHT, "value", l2=1.0)
    return rounded(out, 6, "rmse", "mape")


@query(
    f"WITH {_TWO_SQL}, c AS ({_centred_sql('(SELECT * FROM pt WHERE part = ' + chr(39) + 'train' + chr(39) + ')', 'event_type')}),"
    f" m AS ({_solve_sql('c', 'event_type', l2='0.0')}),"
    " e AS (SELECT event_type, y, w0 + w1 * x1 + w2 * x2 AS yhat FROM pt JOIN m USING (event_type) WHERE part = 'test')"
    f" SELECT event_type, {_err_sql(['rmse'])} FROM e GROUP BY 1"
)
def user_model_per_series(spark, sf):
    """A user's own Python model per series: any function from one series to result rows."""
    import numpy as np
    import pandas as pd

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts")
        test_rows = int(np.ceil(0.2 * len(pdf)))
        x = np.column_stack([np.ones(len(pdf)), pdf[TWO].to_numpy()])
        y = pdf["value"].to_numpy()
        w = np.linalg.lstsq(x[:-test_rows], y[:-test_rows], rcond=None)[0]
        e = y[-test_rows:] - x[-test_rows:] @ w
        return pd.DataFrame({"event_type": [pdf["event_type"].iloc[0]], "rmse": [float(np.sqrt(np.mean(e * e)))]})

    out = models.apply_per_series(two_lags(spark, sf), SERIES, fit, "event_type string, rmse double")
    return rounded(out, 6, "rmse")


# --------------------------------------------------------------------------- tuning

GRID = tuning.grid(l2=[1.0, 100.0, 10000.0], n_lags=[1, 2])
GRID_27 = tuning.grid(l2=[0.1, 0.3, 1.0, 3.0, 10.0, 30.0, 100.0, 300.0, 1000.0], n_lags=[3, 5, 8])
FOLDS = 10

_GRID_SQL = "cand(candidate_id, l2, n_lags) AS (VALUES " + ", ".join(
    f"({c['candidate_id']}, {c['l2']}, {c['n_lags']})" for c in GRID
) + ")"


@query(
    "WITH " + HOURLY_SQL + ", r AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn,"
    " count(*) OVER (PARTITION BY event_type) AS n FROM h), f AS (SELECT unnest(range(10)) AS fold),"
    " x AS (SELECT r.*, CAST(fold AS INTEGER) AS fold, n // 11 AS size FROM r, f),"
    " y AS (SELECT event_type, fold, CASE WHEN rn <= n - (10 - fold) * size THEN 'train' ELSE 'test' END AS role"
    " FROM x WHERE rn <= n - (10 - fold) * size + size), " + _GRID_SQL +
    " SELECT event_type, candidate_id, fold, role, count(*) AS n_rows FROM y, cand GROUP BY 1, 2, 3, 4"
)
def trial_rows(spark, sf):
    """Rows each trial (series, candidate, fold) trains and tests on."""
    out = tuning.expand_trials(hourly(spark, sf), SERIES, "ts", GRID, FOLDS)
    return out.groupBy("event_type", "candidate_id", "fold", "role").agg(F.count(F.lit(1)).alias("n_rows"))


_TUNED27_SQL = (
    _LAG8_SQL + ", tr AS (SELECT * EXCLUDE (rn, n, part), row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn,"
    " count(*) OVER (PARTITION BY event_type) AS n FROM pt WHERE part = 'train'),"
    f" sg AS (SELECT *, CASE WHEN rn <= n - {FOLDS} * (n // {FOLDS + 1}) THEN 0 ELSE ceil((rn - (n - {FOLDS} * (n // {FOLDS + 1}))) / (n // {FOLDS + 1})) END AS seg FROM tr),"
    f" fo AS (SELECT sg.*, fold FROM sg, (SELECT unnest(range({FOLDS + 1})) AS fold) WHERE seg <= fold),"
    " cand(candidate_id, l2, n_lags) AS (VALUES " + ", ".join(f"({c['candidate_id']}, {c['l2']!r}::DOUBLE, {c['n_lags']})" for c in GRID_27) + "),"
    f" ce AS ({_centred_wide_sql('fo', 'event_type, fold', _D8)}), cc AS (SELECT * FROM ce, cand),"
    f" fit AS ({_eliminated_sql('cc', _D8, 'l2', 'n_lags')}),"
    f" ch AS (SELECT event_type, fit.fold, candidate_id, y, {_YHAT8} AS yhat FROM sg JOIN fit USING (event_type) WHERE seg = fit.fold + 1),"
    " fs AS (SELECT event_type, fold, candidate_id, 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS r2 FROM ch GROUP BY 1, 2, 3),"
    " av AS (SELECT event_type, candidate_id, avg(r2) AS cv_score FROM fs GROUP BY 1, 2),"
    # A series too short for folds takes the first candidate and has no fold score.
    " bst AS (SELECT event_type, coalesce(candidate_id, 0) AS candidate_id, cv_score FROM (SELECT DISTINCT event_type FROM fit) LEFT JOIN"
    " (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY cv_score DESC, candidate_id) AS pos FROM av) WHERE pos = 1) USING (event_type)),"
    f" e AS (SELECT event_type, candidate_id, cv_score, l2, n_lags, y, {_YHAT8} AS yhat FROM pt JOIN bst USING (event_type)"
    f" JOIN fit USING (event_type, candidate_id) WHERE part = 'test' AND fold = {FOLDS})"
)


@query(
    f"WITH {_TUNED27_SQL} SELECT event_type, CAST(candidate_id AS BIGINT) AS candidate_id, CAST(fold AS INTEGER) AS fold,"
    " round(avg((y - yhat) * (y - yhat)), 5) + 0.0 AS mse, round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)), 6) + 0.0 AS r2"
    " FROM ch GROUP BY 1, 2, 3"
)
def tuning_fold_scores(spark, sf):
    """27 candidates on eight lags, on every one of ten past-only folds of every series."""
    train = splits.holdout_fraction(lagged(spark, sf), SERIES, "ts", 0.2).where("part = 'train'")
    out = tuning.fold_scores(train, SERIES, "ts", EIGHT, "value", GRID_27, FOLDS)
    return rounded(rounded(out, 5, "mse"), 6, "r2")


@query(
    f"WITH {_TUNED27_SQL} SELECT event_type, CAST(candidate_id AS BIGINT) AS candidate_id, round(cv_score, 6) + 0.0 AS r2 FROM bst WHERE cv_score IS NOT NULL"
)
def best_candidates(spark, sf):
    """Best of 27 candidates per series by mean fold score."""
    train = splits.holdout_fraction(lagged(spark, sf), SERIES, "ts", 0.2).where("part = 'train'")
    scores = tuning.fold_scores(train, SERIES, "ts", EIGHT, "value", GRID_27, FOLDS)
    mean = metrics.mean_over_horizons(scores, [*SERIES, "candidate_id"], ["r2"])
    return rounded(metrics.best_candidate(mean, SERIES, "candidate_id", "r2", smaller_is_better=False), 6, "r2")


@query(
    f"WITH {_TUNED27_SQL} SELECT event_type, CAST(candidate_id AS BIGINT) AS candidate_id, CAST(any_value(l2) AS DOUBLE) AS l2, CAST(any_value(n_lags) AS DOUBLE) AS n_lags,"
    f" round(any_value(cv_score), 6) + 0.0 AS cv_score, count(*) AS n_rows, {_err_sql(['rmse', 'mape'])} FROM e GROUP BY 1, 2"
)
def tuned_series_models(spark, sf):
    """Grid search of 27 candidates per series on ten folds, refit, score on the last fifth."""
    out = tuning.tuned_scores(lagged(spark, sf), SERIES, "ts", EIGHT, "value", GRID_27, FOLDS)
    out = out.select(
        "event_type", "candidate_id",
        F.col("best_params")["l2"].cast("double").alias("l2"), F.col("best_params")["n_lags"].cast("double").alias("n_lags"),
        "cv_score", "n_rows", "rmse", "mape",
    )
    return rounded(out, 6, "cv_score", "rmse", "mape")


@query(
    f"WITH {_TUNED27_SQL} SELECT CAST(candidate_id AS BIGINT) AS candidate_id, round(any_value(cv_score), 6) + 0.0 AS cv_score,"
    f" count(*) AS n_rows, {_err_sql(['rmse', 'mape'])} FROM e WHERE event_type = 'click' GROUP BY 1"
)
def tuned_single_series(spark, sf):
    """The same search on one series; the filter on the series reaches the scan."""
    one = lagged(spark, sf).where("event_type = 'click'")
    out = tuning.tuned_scores(one, SERIES, "ts", EIGHT, "value", GRID_27, FOLDS)
    return rounded(out.select("candidate_id", "cv_score", "n_rows", "rmse", "mape"), 6, "cv_score", "rmse", "mape")


@query(
    f"WITH {_TUNED27_SQL} SELECT event_type, CAST(candidate_id AS BIGINT) AS candidate_id,"
    " '{\"l2\":' || CAST(any_value(l2) AS VARCHAR) || ',\"n_lags\":' || CAST(CAST(any_value(n_lags) AS DOUBLE) AS VARCHAR) || '}' AS best_params,"
    f" round(any_value(cv_score), 6) + 0.0 AS cv_score, count(*) AS n_rows, {_err_sql(['rmse', 'mape'])} FROM e GROUP BY 1, 2"
)
def tuned_series_models_grid_of_27(spark, sf):
    """27 candidates x 10 folds on eight lags, per series; best parameters as text and map."""
    out = tuning.tuned_scores(lagged(spark, sf), SERIES, "ts", EIGHT, "value", GRID_27, FOLDS)
    picked = F.create_map(*[x for n in ("l2", "n_lags") for x in (F.lit(n), F.col("best_params")[n])])
    return rounded(out.withColumn("best_params", F.to_json(picked)), 6, "cv_score", "rmse", "mape")


@query(
    f"WITH {_TUNED27_SQL} SELECT event_type, '{{\"l2\":' || CAST(CAST(l2 AS DOUBLE) AS VARCHAR) || ',\"n_lags\":' || CAST(CAST(n_lags AS DOUBLE) AS VARCHAR) || '}}' AS params"
    " FROM bst JOIN cand USING (candidate_id)"
)
def params_text(spark, sf):
    """Best parameters of each series as text."""
    train = splits.holdout_fraction(lagged(spark, sf), SERIES, "ts", 0.2).where("part = 'train'")
    best = tuning.tune_ridge(train, SERIES, "ts", EIGHT, "value", GRID_27, FOLDS)
    picked = F.create_map(*[x for n in ("l2", "n_lags") for x in (F.lit(n), F.col("best_params")[n])])
    return best.select("event_type", F.to_json(picked).alias("params"))


_AXES = {"l2": ("log", 0.001, 1000.0), "n_lags": ("int", 1, 8)}
_RANDOM = tuning.random_candidates(30, 20244, **_AXES)
_RANDOM_SQL = (
    _LAG8_SQL + ", tr AS (SELECT * EXCLUDE (rn, n, part), row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn,"
    " count(*) OVER (PARTITION BY event_type) AS n FROM pt WHERE part = 'train'),"
    " iv AS (SELECT *, rn > n - ceil(n * 0.2) AS held FROM tr),"
    " cand(candidate_id, l2, n_lags) AS (VALUES " + ", ".join(f"({c['candidate_id']}, {c['l2']!r}::DOUBLE, {c['n_lags']})" for c in _RANDOM) + "),"
    f" c1 AS ({_centred_wide_sql('(SELECT * FROM iv WHERE NOT held)', 'event_type', _D8)}), c1c AS (SELECT * FROM c1, cand),"
    f" m1 AS ({_eliminated_sql('c1c', _D8, 'l2', 'n_lags')}),"
    f" v AS (SELECT event_type, candidate_id, {_ERR['mape'].replace('yhat', '(' + _YHAT8 + ')')} AS validation_mape"
    " FROM iv JOIN m1 USING (event_type) WHERE held GROUP BY 1, 2),"
    " bst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY validation_mape, candidate_id) AS pos FROM v) WHERE pos = 1),"
    f" c2 AS ({_centred_wide_sql('tr', 'event_type', _D8)}), c2c AS (SELECT * FROM c2 JOIN bst USING (event_type) JOIN cand USING (candidate_id)),"
    f" m2 AS ({_eliminated_sql('c2c', _D8, 'l2', 'n_lags')}),"
    f" e AS (SELECT event_type, candidate_id, validation_mape, y, {_YHAT8} AS yhat FROM pt JOIN m2 USING (event_type) WHERE part = 'test')"
)


@query(
    f"WITH {_RANDOM_SQL} SELECT event_type, CAST(candidate_id AS BIGINT) AS candidate_id, round(validation_mape, 6) AS validation_mape,"
    f" count(*) AS n_rows, {_err_sql(['rmse', 'mape'])} FROM e GROUP BY 1, 2, 3"
)
def random_search(spark, sf):
    """30 random trials per series on eight lags, spread over the executors; choose by MAPE, refit, score."""
    out = tuning.random_search(lagged(spark, sf), SERIES, "ts", EIGHT, "value", _RANDOM)
    return rounded(out, 6, "validation_mape", "rmse", "mape")


@query()
def adaptive_search(spark, sf):
    """30 adaptive trials per series on eight lags and ten folds, refit, score on the last fifth."""
    return search.adaptive_search(lagged(spark, sf), SERIES, "ts", EIGHT, "value", _AXES, FOLDS, rounds=3, per_round=10, seed=20244)


@query()
def adaptive_trials(spark, sf):
    """Every trial of every series' search, with the folds it saw before it was stopped."""
    train = splits.holdout_fraction(lagged(spark, sf), SERIES, "ts", 0.2).where("part = 'train'")
    return search.adaptive_trials(train, SERIES, "ts", EIGHT, "value", _AXES, FOLDS, rounds=3, per_round=10, seed=20244)


@query(
    f"WITH {_TUNED27_SQL} SELECT event_type, 30::BIGINT AS n_trials, 6::BIGINT AS n_full, true AS within_grid FROM bst"
)
def adaptive_search_quality(spark, sf):
    """Trials and unstopped trials of every series, and whether the best fold score of an adaptive
    search comes within 0.01 of the best of the full grid (or there are no folds)."""
    train = splits.holdout_fraction(lagged(spark, sf), SERIES, "ts", 0.2).where("part = 'train'")
    trials = search.adaptive_trials(train, SERIES, "ts", EIGHT, "value", _AXES, FOLDS, rounds=3, per_round=10, seed=20244)
    best = trials.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_trials"), F.count_if(~F.col("stopped")).alias("n_full"), F.max(F.when(~F.col("stopped"), F.col("score"))).alias("found"))
    grid = tuning.tune_ridge(train, SERIES, "ts", EIGHT, "value", GRID_27, FOLDS).select("event_type", "cv_score")
    near = F.coalesce(F.col("found") >= F.col("cv_score") - 0.01, F.lit(True))
    return join_on(best, grid, SERIES).select("event_type", "n_trials", "n_full", near.alias("within_grid"))


# --------------------------------------------------------------------------- attribution

_ATTR_SQL = (
    f"{_TWO_SQL}, c AS ({_centred_sql('l', 'event_type')}), m AS ({_solve_sql('c', 'event_type')}),"
    " a AS (SELECT l.event_type, ts, w0 + w1 * m1 + w2 * m2 AS base, w1 * (x1 - m1) AS g1, w2 * (x2 - m2) AS g2 FROM l JOIN m USING (event_type))"
)


def _contributions(spark, sf):
    rows = two_lags(spark, sf)
    return models.linear_contributions(rows, models.fit_ridge(rows, SERIES, TWO, "value", l2=1.0), SERIES, TWO)


@query(
    f"WITH {_ATTR_SQL} SELECT event_type, ts, round(base, 6) AS base, round(g1, 6) + 0.0 AS value_lag1_contribution,"
    " round(g2, 6) + 0.0 AS value_lag24_contribution FROM a"
)
def feature_contributions(spark, sf):
    """Contribution of each lag to each prediction."""
    out = _contributions(spark, sf).drop("value", *TWO)
    return rounded(out, 6, *out.columns[2:])


@query(
    f"WITH {_ATTR_SQL} SELECT event_type, 'value_lag1' AS feature, round(avg(abs(g1)), 6) AS mean_abs_contribution FROM a GROUP BY 1"
    " UNION ALL SELECT event_type, 'value_lag24' AS feature, round(avg(abs(g2)), 6) AS mean_abs_contribution FROM a GROUP BY 1"
)
def feature_summary(spark, sf):
    """Mean absolute contribution per series and lag."""
    return rounded(models.mean_attribution(_contributions(spark, sf), SERIES, TWO), 6, "mean_abs_contribution")


@query(
    f"WITH {_ATTR_SQL}, u AS (SELECT event_type, ts, unnest(['value_lag1', 'value_lag24']) AS feature, unnest([g1, g2]) AS g FROM a)"
    " SELECT event_type, ts, CAST(row_number() OVER (PARTITION BY event_type, ts ORDER BY abs(g) DESC, feature) AS INTEGER) AS rank, feature,"
    " round(g, 6) + 0.0 AS contribution FROM u"
)
def feature_waterfall(spark, sf):
    """Contributions of each row ranked by size."""
    return rounded(models.top_attribution(_contributions(spark, sf), ["event_type", "ts"], TWO), 6, "contribution")


# --------------------------------------------------------------------------- one tree model over all series

@query()
def boosted_trees(spark, sf):
    """One gradient-boosted model over all series, scored on the last 48 hours of each."""
    parts = splits.holdout_last(lagged(spark, sf), SERIES, "ts", 48)
    model = ensemble.fit_trees(parts.where("part = 'train'"), EIGHT, "value")
    scored = model.transform(parts.where("part = 'test'"))
    return metrics.score(scored, "value", "prediction", SERIES, ["rmse", "mae", "mape"])


def _tree_contributions(spark, sf):
    parts = splits.holdout_last(lagged(spark, sf), SERIES, "ts", 48)
    with kept(parts) as rows:
        model = ensemble.fit_trees(rows.where("part = 'train'"), EIGHT, "value")
    scored = model.transform(parts.where("part = 'test'")).select("event_type", "ts", "prediction", *EIGHT)
    return attribution.tree_contributions(scored, model, EIGHT).drop(*EIGHT)


@query()
def tree_contributions(spark, sf):
    """Shapley values of the single tree model for the last 48 hours of each series."""
    return _tree_contributions(spark, sf)


@query()
def tree_feature_summary(spark, sf):
    """Mean absolute Shapley value per series and lag."""
    return models.mean_attribution(_tree_contributions(spark, sf), SERIES, EIGHT)


@query(
    f"WITH {_LAG8_SQL} SELECT event_type, least(count(*), 48)::BIGINT AS n_rows, true AS adds_up FROM l GROUP BY 1"
)
def tree_contributions_add_up(spark, sf):
    """Base plus contributions is the model's prediction for every explained row."""
    total = F.col("base") + functools.reduce(Column.__add__, [F.col(f"{f}_contribution") for f in EIGHT])
    near = F.max(F.abs(total - F.col("prediction"))) < 1e-6
    return _tree_contributions(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), near.alias("adds_up"))


@query()
def boosted_trees_grid(spark, sf):
    """Assembler and grid search over contiguous time blocks, mean RMSE per grid point."""
    rows = ensemble.time_fold_column(lagged(spark, sf), SERIES, "ts", 3)
    pipeline = ensemble.cross_validated_trees(EIGHT, "value", max_depth=(2, 4), n_trees=(3, 5), k=3)
    table_rows = ensemble.grid_table(ensemble.fit_kept(pipeline, rows))
    return spark.createDataFrame(table_rows, "maxDepth int, maxIter int, rmse double")


@query()
def boosted_trees_past_only(spark, sf):
    """RMSE of grid points on expanding windows, each fitted on the past alone."""
    return ensemble.past_only_scores(
        lagged(spark, sf), SERIES, "ts", EIGHT, "value", max_depth=(2,), n_trees=(3,), k=3
    )


# --------------------------------------------------------------------------- synthetic series

@query()
def synthetic_series(spark, sf):
    """Four synthetic series drawn from a copula of price, quantity and discount, on the source
    time grid; mean and deviation of every series and column."""
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    source = table(spark, sf, "lineitem")
    panel = synth.synthetic_panel(source, cols, ["l_orderkey", "l_linenumber"], 5, "cust_id", ["l_shipdate"])
    stats = [f(c).alias(f"{n}_{c}") for c in cols for n, f in (("mean", F.avg), ("sd", F.stddev))]
    return panel.groupBy("cust_id").agg(F.count(F.lit(1)).alias("n"), *stats)


@query(
    "SELECT CAST(c AS INTEGER) AS cust_id, n, true AS own_values, true AS means_near, true AS deviations_near"
    " FROM (SELECT unnest(range(1, 6)) AS c), (SELECT count(*) AS n FROM lineitem)"
)
def synthetic_series_fidelity(spark, sf):
    """Every synthetic series has the rows of the source, the first one its values, the others its
    means (within 3 %) and deviations (within 6 %)."""
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    source = table(spark, sf, "lineitem")
    panel = synth.synthetic_panel(source, cols, ["l_orderkey", "l_linenumber"], 5, "cust_id", ["l_shipdate"])
    stats = [f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in cols for n, f in (("mean", F.avg), ("sd", F.stddev))]
    base = source.agg(*[s.alias(f"base_{n}") for s, n in zip(stats, (f"{n}_{c}" for c in cols for n in ("mean", "sd")))])
    rows = join_on(panel.groupBy("cust_id").agg(F.count(F.lit(1)).alias("n"), *stats), base, [])

    def near(kind: str, share: float):
        return functools.reduce(Column.__and__, [F.abs(F.col(f"{kind}_{c}") / F.col(f"base_{kind}_{c}") - 1) <= share for c in cols])

    own = (F.col("cust_id") != 1) | (near("mean", 1e-9) & near("sd", 1e-9))
    return rows.select("cust_id", "n", own.alias("own_values"), near("mean", 0.03).alias("means_near"), near("sd", 0.06).alias("deviations_near"))


# --------------------------------------------------------------------------- quality and reports

_RULES = {
    "events": {"value_over_10": "value > 10", "has_type": "event_type IS NOT NULL"},
    "orders": {"positive_price": "o_totalprice > 0", "has_date": "o_orderdate IS NOT NULL"},
    "lineitem": {"discount_range": "l_discount BETWEEN 0 AND 0.1"},
}


def _checks(spark, sf):
    parts = [quality.expect(table(spark, sf, name), name, rules) for name, rules in _RULES.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_DQ_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, '{rule}' AS expectation, count(*) FILTER ({text}) AS passing_records,"
    f" count(*) FILTER (NOT coalesce({text}, false)) AS failing_records FROM {name}"
    for name, rules in _RULES.items()
    for rule, text in rules.items()
)


@query(_DQ_SQL)
def quality_results(spark, sf):
    return _checks(spark, sf)


@query(
    f"WITH q AS ({_DQ_SQL}) SELECT dataset, expectation, CAST(sum(passing_records) AS BIGINT) AS passing_records,"
    " CAST(sum(failing_records) AS BIGINT) AS failing_records FROM q GROUP BY 1, 2"
)
def quality_summary(spark, sf):
    return quality.summarize(_checks(spark, sf))


@query(
    f"WITH {_RUN_JOIN} SELECT max(ds) AS max_date, round(median(abs((y - yhat) / y)), 6) AS mdape, runid AS model_version FROM j GROUP BY runid"
)
def forecast_quality(spark, sf):
    """Newest date and MdAPE of every model version."""
    forecasts = backtest.walk_forward_forecast(daily(spark, sf), RUNS)
    rows = backtest.evaluation_rows(_run_actuals(spark, sf), forecasts, ["runid", "ds"])
    return rounded(reports.forecast_quality(rows, "runid", "ds"), 6, "mdape")


@query(
    "WITH RECURSIVE " + HOURLY_SQL + ", " + EMA_SQL +
    ", x AS (SELECT *, date_diff('day', DATE '2000-01-01', CAST(ts AS DATE)) AS t, hour(ts) AS hr FROM h),"
    " m AS (SELECT event_type, regr_slope(value, t) AS b, regr_intercept(value, t) AS a FROM x GROUP BY 1),"
    " s AS (SELECT x.event_type, hr, avg(value - a - b * t) AS off FROM x JOIN m USING (event_type) GROUP BY 1, 2)"
    " SELECT x.event_type, x.ts AS ts, round(x.value, 6) AS hourly_value, round(e.ema, 6) AS hourly_ema_value,"
    " round(a + b * t + off, 5) + 0.0 AS yhat FROM x JOIN m USING (event_type) JOIN s USING (event_type, hr)"
    " JOIN e ON e.event_type = x.event_type AND e.ts = x.ts"
)
def forecast_vs_actual(spark, sf):
    """Hourly value, its exponential average and the fitted forecast side by side."""
    out = reports.forecast_and_actuals(hourly(spark, sf), SERIES, "ts", "value", alpha=0.1)
    return rounded(rounded(out, 6, "hourly_value", "hourly_ema_value"), 5, "yhat")
