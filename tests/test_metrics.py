import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkseries.operators import metrics


def frame(spark, pairs, k="a"):
    return spark.createDataFrame([(k, y, p) for y, p in pairs], "k string, y double, yhat double")


def test_measures_by_hand(spark):
    y, p = np.array([1.0, 2.0, 4.0, -3.0]), np.array([2.0, 2.0, 1.0, -5.0])
    df = frame(spark, zip(y.tolist(), p.tolist())).withColumns({"yhat_lower": F.col("yhat") - 1, "yhat_upper": F.col("yhat") + 1})
    got = metrics.score(df, "y", "yhat", ["k"], list(metrics.ALL_METRICS)).first()
    e = y - p
    want = {
        "mse": np.mean(e**2), "rmse": np.sqrt(np.mean(e**2)), "mae": np.mean(abs(e)), "mape": np.mean(abs(e / y)),
        "smape": np.mean(abs(e) / ((abs(y) + abs(p)) / 2)), "wape": abs(e).sum() / abs(y).sum(),
        "mdape": np.median(abs(e / y)), "coverage": 0.5, "r2": 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum(),
        "mean_error": e.mean(), "max_error": abs(e).max(),
    }
    assert got.n_rows == 4
    for name, value in want.items():
        assert got[name] == pytest.approx(value, rel=1e-12), name


def test_zero_actuals(spark):
    got = metrics.score(frame(spark, [(0.0, 0.0), (0.0, 1.0)]), "y", "yhat", ["k"], ["mape", "smape", "wape", "mdape"]).first()
    assert got.mape == pytest.approx(0.5 / 2.220446049250313e-16)
    assert got.smape == 1.0 and got.wape is None and got.mdape is None


def test_nulls_on_either_side_do_not_count(spark):
    df = frame(spark, [(1.0, 2.0), (None, 1.0), (5.0, None)])
    got = metrics.score(df, "y", "yhat", [], ["mae", "wape", "r2", "mdape"]).first()
    assert (got.n_rows, got.mae, got.wape, got.mdape) == (1, 1.0, 1.0, 1.0)


def test_all_null_group_keeps_its_row(spark):
    df = frame(spark, [(None, None)], "n").unionByName(frame(spark, [(1.0, 1.0)]))
    got = {r.k: r for r in metrics.score(df, "y", "yhat", ["k"], ["rmse", "mdape"]).collect()}
    assert got["n"].n_rows == 0 and got["n"].rmse is None and got["n"].mdape is None
    assert got["a"].rmse == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 11, 1000, 1001, 30_001])
def test_exact_median(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.lognormal(size=n), 2)
    rows = [(("hot" if i % 3 else None), float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.m for r in metrics.exact_median(df, ["k"], "v", "m").collect()}
    for key in {k for k, _ in rows}:
        assert got[key] == pytest.approx(np.median([v for k, v in rows if k == key]), rel=1e-14)
    assert metrics.exact_median(df, [], "v", "m").first().m == pytest.approx(np.median(values), rel=1e-14)


def test_exact_median_of_one_repeated_value(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.when(F.col("id") < 4000, 2.5).otherwise(F.col("id") / 1.0).alias("v"))
    assert metrics.exact_median(df, ["k"], "v", "m").first().m == 2.5


def test_median_choices_agree(spark):
    df = frame(spark, [(float(i), float(i + i % 7)) for i in range(1, 500)])
    found = [metrics.score(df, "y", "yhat", ["k"], ["mdape"], median=m).first().mdape for m in ("exact", "grouped")]
    assert found[0] == pytest.approx(found[1], rel=1e-14)


@pytest.mark.parametrize("window", [1, 3])
def test_rolling_horizons(spark, window):
    rng = np.random.default_rng(0)
    c = dt.date(2020, 1, 1)
    rows = [(c, c + dt.timedelta(h), float(rng.normal()), 0.0) for h in range(1, 8) for _ in range(h % 3 + 1)]
    df = spark.createDataFrame(rows, "cutoff date, ds date, y double, yhat double")
    got = {r.horizon: r for r in metrics.score_by_horizon(df, "y", "yhat", "ds", window=window, metrics=["mae", "mdape"]).collect()}
    assert sorted(got) == list(range(window, 8))
    for h, r in got.items():
        e = [abs(y) for _, d, y, _ in rows if h - window < (d - c).days <= h]
        assert r.n_rows == len(e) and r.mae == pytest.approx(np.mean(e)) and r.mdape == 1.0


def test_windows_from_sums_equal_windows_of_rows(spark):
    """All measures over rolling horizons, with ties, gaps, nulls, uneven horizons and several series."""
    rng = np.random.default_rng(5)
    c = dt.date(2020, 1, 1)
    rows = []
    for k in ("a", "b", None):
        for h in (1, 2, 3, 4, 5, 8, 9, 10, 15):
            for _ in range(int(rng.integers(1, 40))):
                y = float(rng.choice([0.0, 1.0, 2.0, rng.normal() * 10]))
                p = float(y + rng.choice([0.0, 0.5, rng.normal()]))
                rows.append((k, c, c + dt.timedelta(h), None if rng.random() < 0.05 else y, None if rng.random() < 0.05 else p, p - 0.4, p + 0.4))
    df = spark.createDataFrame(rows, "k string, cutoff date, ds date, y double, yhat double, yhat_lower double, yhat_upper double")
    names = [*metrics.WINDOWED, "mdape"]
    for by in (["k"], []):
        for window in (2, 4, 30):
            got = metrics.score_by_horizon(df, "y", "yhat", "ds", by=by, window=window, metrics=names).collect()
            copied = df.withColumn("horizon", F.datediff("ds", "cutoff")).withColumn("_last", F.lit(15))
            want = metrics.score(metrics._reaching(copied, window), "y", "yhat", [*by, "horizon"], names, median="grouped").collect()
            key = lambda r: (str(r.k) if by else "", r.horizon)
            assert sorted(map(key, got)) == sorted(map(key, want)) and (len(got) > 0) == (window < 30)
            for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
                assert a.n_rows == b.n_rows
                for m in names:
                    assert (a[m] is None) == (b[m] is None) and (a[m] is None or a[m] == pytest.approx(b[m], rel=1e-9, abs=1e-12)), m


def test_horizon_given_equals_horizon_found(spark):
    c = dt.date(2020, 1, 1)
    rows = [("a", c, c + dt.timedelta(h), float(h), 1.0) for h in range(1, 6)]
    df = spark.createDataFrame(rows, "k string, cutoff date, ds date, y double, yhat double")
    a = metrics.score_by_horizon(df, "y", "yhat", "ds", by=["k"], window=2, horizon=5, metrics=["mae"]).collect()
    b = metrics.score_by_horizon(df, "y", "yhat", "ds", by=["k"], window=2, metrics=["mae"]).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == 4


def test_best_candidate_breaks_ties_by_id(spark):
    df = spark.createDataFrame(
        [("a", 2, 0.5), ("a", 1, 0.5), ("a", 0, 0.7), ("b", 0, None), ("b", 1, float("nan")), ("b", 2, 3.0)],
        "k string, candidate_id int, mse double",
    )
    got = {r.k: r.candidate_id for r in metrics.best_candidate(df, ["k"], "candidate_id", "mse").collect()}
    assert got == {"a": 1, "b": 2}


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        metrics.score(frame(spark, []), "y", "yhat", [], ["nope"])
