import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkseries.operators import forecast, splits
from sparkseries.operators.additive import design, fit_additive_ridge
from sparkseries.plans.backtest import RunWindow, assign_runs, walk_forward, walk_forward_forecast, yearly_runs


def line(spark, n=60, k="a", slope=2.0, start="2020-01-01"):
    return spark.range(n).select(
        F.lit(k).alias("k"),
        F.expr(f"date_add(date'{start}', cast(id as int))").alias("ds"),
        (F.lit(3.0) + slope * F.col("id")).alias("y"),
    )


def test_known_line_is_recovered(spark):
    out = forecast.additive_forecast(line(spark), ["k"], horizon=10).orderBy("ds").collect()
    assert len(out) == 10
    assert [r.yhat for r in out] == pytest.approx([3 + 2 * i for i in range(60, 70)], rel=1e-9)
    assert all(r.yhat_upper - r.yhat_lower < 1e-3 for r in out)


def test_interval_contains_the_forecast_and_has_its_width(spark):
    rng = np.random.default_rng(5)
    base = dt.date(2020, 1, 1)
    rows = [("a", base + dt.timedelta(i), float(rng.normal())) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    out = forecast.additive_forecast(df, ["k"], horizon=5).collect()
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in out)
    assert np.mean([(r.yhat_upper - r.yhat_lower) / 2 for r in out]) == pytest.approx(1.2816, rel=0.05)


def test_rows_are_series_times_horizon(spark):
    df = line(spark).unionByName(line(spark, 1, "one")).unionByName(line(spark, 2, "two"))
    out = forecast.additive_forecast(df, ["k"], horizon=7)
    assert out.count() == 21 and out.where("yhat IS NULL OR yhat_lower > yhat_upper").count() == 0
    assert out.where("k = 'one'").select("yhat").distinct().collect()[0].yhat == 3.0


def test_all_null_series_has_no_forecast(spark):
    df = line(spark).withColumn("y", F.lit(None).cast("double"))
    assert forecast.additive_forecast(df, ["k"], horizon=7).count() == 0


def test_null_values_and_gaps_do_not_bend_the_line(spark):
    df = line(spark).withColumn("y", F.when(F.dayofmonth("ds") != 9, F.col("y"))).where("day(ds) NOT IN (3, 4)")
    out = forecast.additive_forecast(df, ["k"], horizon=3).orderBy("ds").collect()
    assert [r.yhat for r in out] == pytest.approx([123, 125, 127], rel=1e-9)


def test_history_and_end_date(spark):
    out = forecast.additive_forecast(line(spark), ["k"], horizon=None, until=F.lit("2020-03-10").cast("date"), include_history=True)
    days = sorted(r.ds for r in out.collect())
    assert days[0] == dt.date(2020, 1, 1) and days[-1] == dt.date(2020, 3, 10) and len(days) == 70
    with pytest.raises(ValueError):
        forecast.additive_forecast(line(spark), ["k"], horizon=None)


def test_leap_year_keeps_its_last_day(spark):
    runs = [RunWindow(1, "1983-01-01", "1987-12-31", "1988-12-31")]
    out = walk_forward_forecast(line(spark, 365 * 5 + 1, start="1983-01-01").drop("k"), runs)
    assert out.count() == 366


def test_ridge_without_penalty_recovers_a_line(spark):
    df = line(spark, 900).unionByName(line(spark, 900, "b", -1.0))
    out = forecast.additive_forecast(df, ["k"], horizon=5, model="ridge", l2_trend=0.0, l2_season=0.0)
    for r in out.collect():
        slope = 2.0 if r.k == "a" else -1.0
        assert r.yhat == pytest.approx(3 + slope * (r.ds - dt.date(2020, 1, 1)).days, rel=1e-4)


def test_ridge_equals_a_direct_solve_and_ignores_block_size(spark):
    rng = np.random.default_rng(2)
    base = dt.date(2018, 1, 1)
    rows = [("a", base + dt.timedelta(int(i)), float(10 + np.sin(i / 58) + rng.normal())) for i in range(0, 1200, 1) if i % 11]
    df = spark.createDataFrame(rows + rows[:50], "k string, ds date, y double")  # some days twice
    pdf = df.toPandas()
    day = np.array([(d - dt.date(2000, 1, 1)).days for d in pdf.ds], dtype=float)
    x = design(day, np.full_like(day, day.min()), np.full_like(day, day.max()))
    penalty = np.concatenate([np.full(2, 1e-10), np.full(25, 1 + 1e-10), np.full(26, 0.1 + 1e-10)])
    want = np.linalg.solve(x.T @ x + np.diag(penalty), x.T @ pdf.y.to_numpy())
    for block_days in (100, 5000):
        m = fit_additive_ridge(df, ["k"], block_days=block_days).first()
        assert x @ np.array(m.weights) == pytest.approx(x @ want, abs=1e-6)
        assert m.n_obs == len(pdf)


def test_rolling_origin_equals_one_fit_per_cutoff(spark):
    rng = np.random.default_rng(4)
    base = dt.date(2020, 1, 1)
    rows = [("a", base + dt.timedelta(i), float(i + rng.normal())) for i in range(80)]
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    out = forecast.rolling_origin(df, ["k"], initial=40, period=10, horizon=10).toPandas()
    assert sorted(out.groupby("cutoff").size()) == [10] * 3  # cutoffs at day 49, 59 and 69
    for cutoff, part in out.groupby("cutoff"):
        one = forecast.additive_forecast(df.where(F.col("ds") <= F.lit(cutoff)), ["k"], horizon=10).toPandas()
        both = part.merge(one, on="ds", suffixes=("", "_one"))
        assert len(both) == 10 and np.allclose(both.yhat, both.yhat_one) and np.allclose(both.yhat_lower, both.yhat_lower_one)


def test_fits_at_cutoffs_equal_fits_of_copied_rows(spark):
    """Gaps, nulls, missing weekdays, short series and a level of 1e9."""
    rng = np.random.default_rng(14)
    base = dt.date(2020, 1, 1)
    rows = []
    for k, level in (("a", 0.0), ("b", 1e9), (None, 5.0)):
        for i in range(200):
            if rng.random() < 0.7 and (i % 7 != 3 or i > 150):
                rows.append((k, base + dt.timedelta(i), None if rng.random() < 0.1 else float(level + i * 0.3 + rng.normal())))
    rows += [("short", base, 1.0), ("short", base + dt.timedelta(20), 2.0)]
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    span = dict(initial=60, period=17, horizon=20)
    got = {(r.k, r.cutoff): r for r in forecast.fit_trend_season_at_cutoffs(df, ["k"], **span).collect()}
    train = splits.cutoff_folds(df, ["k"], "ds", **span, roles=["train"], value="y")
    want = {(r.k, r.cutoff): r for r in forecast.fit_trend_season(train, ["k", "cutoff"]).collect()}
    assert set(got) == set(want) and len(got) >= 15
    for key, a in got.items():
        b = want[key]
        assert (a.n_obs, a.first_ds, a.last_ds) == (b.n_obs, b.first_ds, b.last_ds)
        for name in ("slope", "sigma"):
            assert a[name] == pytest.approx(b[name], rel=1e-5, abs=1e-7)
        assert a.intercept == pytest.approx(b.intercept, rel=1e-9, abs=1e-4)
        assert a.season_offsets.keys() == b.season_offsets.keys()
        assert all(a.season_offsets[s] == pytest.approx(b.season_offsets[s], abs=1e-5) for s in b.season_offsets)


def test_rolling_origin_ridge(spark):
    df = line(spark, 130)
    out = forecast.rolling_origin(df, ["k"], initial=100, period=10, horizon=10, model="ridge")
    assert out.count() == 20 and out.where("yhat IS NULL").count() == 0


def test_run_windows(spark):
    runs = yearly_runs(1981)
    assert (runs[0].start, runs[0].train_end, runs[0].eval_end) == ("1981-01-01", "1985-12-31", "1986-12-31")
    assert runs[4] == RunWindow(5, "1985-01-01", "1989-12-31", "1990-12-31")
    df = line(spark, 4000, start="1981-01-01").drop("k")
    literal = assign_runs(df, "ds", runs)
    joined = assign_runs(df, "ds", runs, literal_runs=0)
    assert sorted(map(tuple, literal.collect())) == sorted(map(tuple, joined.collect()))
    for plan in (literal, joined):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_walk_forward_single_series_and_panel_agree(spark):
    df = line(spark, 365 * 4, start="2015-01-01")
    runs = yearly_runs(2015, n_runs=2, train_years=2)
    one = walk_forward(df.drop("k"), runs).orderBy("runid").collect()
    panel = walk_forward(df, runs, ["k"]).orderBy("runid").collect()
    assert [r.n_rows for r in one] == [r.n_rows for r in panel] == [365, 364]
    assert all(r.rmse < 1e-6 for r in one)


def test_shared_scan_in_the_walk_forward_plan(spark, sf):
    from sparkseries.plans.queries import QUERIES

    df = QUERIES["walk_forward"](spark, sf)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_season_comes_from_the_model(spark):
    rows = [(f"2020-{m:02d}-{d:02d}", float(100 * m)) for m in range(1, 13) for d in (1, 11, 21)]
    df = spark.createDataFrame(rows, "ds string, y double").withColumn("ds", F.col("ds").cast("date"))
    model = forecast.fit_trend_season(df, [], season="month")
    out = forecast.predict_trend_season(model.crossJoin(df), [], keep=["y"]).collect()
    assert max(abs(r.yhat - r.y) for r in out) < 60


@pytest.mark.parametrize("name", ["season", "n", "y_", "t", "yy", "first_ds_"])
def test_any_key_name(spark, name):
    df = spark.createDataFrame([("a", f"2020-01-{d:02d}", float(d)) for d in range(1, 15)], f"{name} string, ds string, y double")
    df = df.withColumn("ds", F.col("ds").cast("date"))
    assert forecast.fit_trend_season(df, [name]).count() == 1
