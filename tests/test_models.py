import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkseries.functions import linalg
from sparkseries.operators import ensemble, features, forecast, models, synth, tuning
from sparkseries.operators.additive import fit_additive_ridge


@pytest.fixture(scope="module")
def ar1(spark):
    """Five AR(1) series, y[t] = 0.8*y[t-1] + e, with three lags as features."""
    rng = np.random.default_rng(9)
    parts = []
    for k in range(5):
        y = np.zeros(400)
        for t in range(1, 400):
            y[t] = 0.8 * y[t - 1] + rng.normal()
        parts.append(pd.DataFrame({"k": k, "t": np.arange(400), "y": y}))
    pdf = pd.concat(parts)
    for lag in (1, 2, 3):
        pdf[f"y_lag{lag}"] = pdf.groupby("k").y.shift(lag)
    return spark.createDataFrame(pdf.dropna()).cache()


X = ["y_lag1", "y_lag2", "y_lag3"]


def direct(x, y, l2):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + l2 * np.eye(x.shape[1]), xc.T @ yc)
    return y.mean() - x.mean(0) @ w, w


def test_moments_of_parts_combine():
    x = np.random.default_rng(1).normal(5, 2, (40, 4))

    def of(part):
        c = part - part.mean(0)
        packed = [len(part), *part.mean(0), *(c.T @ c)[np.triu_indices(4)]]
        return linalg.unpack(packed, 3)

    whole = of(x)
    both = linalg.combine(linalg.combine(linalg.empty(3), of(x[:7])), of(x[7:]))
    assert both.n == whole.n and np.allclose(both.mean, whole.mean) and np.allclose(both.centred, whole.centred)


@pytest.mark.parametrize("level", [0.0, 1e6, 1e9])
def test_fits_do_not_depend_on_the_level(spark, level):
    """Weights, errors and intervals are those of the same series near zero."""
    rng = np.random.default_rng(4)
    rows = [("a", i, float(np.round(v * 64) / 64)) for i, v in enumerate(rng.normal(0, 1, 400))]
    base = spark.createDataFrame(rows, "k string, t int, y double").withColumn("t", F.date_add(F.lit("2020-01-01").cast("date"), F.col("t")))
    high = base.withColumn("y", F.col("y") + level)

    def results(df):
        table = features.lag_table(df, ["k"], "t", "y", (1, 2))
        names = ["y_lag1", "y_lag2"]
        ridge = models.fit_ridge(table, ["k"], names, "y", 1.0).first()
        tuned = tuning.tuned_scores(table, ["k"], "t", names, "y", tuning.grid(l2=[1.0, 50.0]), 4, metrics=["rmse"]).first()
        season = forecast.fit_trend_season(df, ["k"], "t", "y").first()
        smooth = fit_additive_ridge(df, ["k"], "t", "y").first()
        return np.array([*ridge.weights, tuned.cv_score, tuned.rmse, season.slope, season.sigma, *sorted(v - 0 for v in season.season_offsets.values()), smooth.sigma])

    assert np.allclose(results(base), results(high), atol=2e-6)


def test_series_too_short_for_folds_keep_their_row(spark):
    rows = [("long", i, float(i % 7), float(i % 5)) for i in range(60)] + [("short", i, float(i % 3), 1.0 + i) for i in range(6)] + [("one", 0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, t int, x double, y double")
    out = {r.k: r for r in tuning.tuned_scores(df, ["k"], "t", ["x"], "y", tuning.grid(l2=[1.0, 2.0]), 10).collect()}
    assert set(out) == {"long", "short", "one"}
    assert out["short"].candidate_id == 0 and out["short"].cv_score is None and out["short"].rmse is not None
    assert out["one"].candidate_id is None and out["one"].rmse is None
    searched = tuning.random_search(df, ["k"], "t", ["x"], "y", tuning.grid(l2=[1.0, 2.0]))
    assert {r.k for r in searched.collect()} >= {"long", "short"}


def test_ridge_equals_a_direct_solve(ar1):
    pdf = ar1.toPandas()
    for l2 in (0.0, 5.0):
        for r in models.fit_ridge(ar1, ["k"], X, "y", l2).collect():
            part = pdf[pdf.k == r.k]
            b, w = direct(part[X].to_numpy(), part.y.to_numpy(), l2)
            assert r.intercept == pytest.approx(b, abs=1e-9) and r.weights == pytest.approx(list(w), abs=1e-9)
            assert r.n_train == len(part)


def test_lag_one_weight_is_found(ar1):
    assert all(abs(r.weights[0] - 0.8) < 0.15 for r in models.fit_ridge(ar1, ["k"], X, "y", 1.0).collect())


def test_constant_feature_does_not_fail(spark):
    df = spark.createDataFrame([(0, float(i), 1.0) for i in range(5)], "k int, y double, x double")
    r = models.fit_ridge(df, ["k"], ["x"], "y", 0.0).first()
    assert r.intercept + r.weights[0] == pytest.approx(2.0)


def test_per_series_scores(ar1):
    pdf = ar1.toPandas()
    got = {r.k: r for r in models.per_series_scores(ar1, ["k"], "t", X, "y", 1.0).collect()}
    for k, part in pdf.groupby("k"):
        part = part.sort_values("t")
        n_test = int(np.ceil(0.2 * len(part)))
        b, w = direct(part[X].to_numpy()[:-n_test], part.y.to_numpy()[:-n_test], 1.0)
        e = part.y.to_numpy()[-n_test:] - b - part[X].to_numpy()[-n_test:] @ w
        assert got[k].n_rows == n_test and got[k].rmse == pytest.approx(np.sqrt(np.mean(e**2)), rel=1e-9)


def test_user_model_per_series(ar1):
    def fit(pdf):
        return pd.DataFrame({"k": [pdf.k.iloc[0]], "n": [len(pdf)]})

    out = models.apply_per_series(ar1, ["k"], fit, "k long, n long").collect()
    assert {r.n for r in out} == {397} and len(out) == 5


def test_contributions_add_up(ar1):
    model = models.fit_ridge(ar1, ["k"], X, "y")
    parts = models.linear_contributions(ar1, model, ["k"], X)
    sums = parts.withColumn("sum", F.col("base") + sum(F.col(f"{x}_contribution") for x in X))
    both = sums.join(models.predict_ridge(ar1, model, ["k"], X).select("k", "t", "yhat"), ["k", "t"])
    assert both.where(F.abs(F.col("sum") - F.col("yhat")) > 1e-9).count() == 0
    assert models.mean_attribution(parts, ["k"], X).count() == 15
    top = models.top_attribution(parts, ["k", "t"], X, 1)
    assert top.count() == ar1.count() and top.where("rank != 1").count() == 0


# ------------------------------------------------------------------ tuning

def test_fold_scores_equal_brute_force(ar1):
    grid = tuning.grid(l2=[0.5, 50.0], n_lags=[1, 3])
    got = {(r.k, r.candidate_id, r.fold): r for r in tuning.fold_scores(ar1, ["k"], "t", X, "y", grid, 4).collect()}
    pdf = ar1.toPandas()
    assert len(got) == 5 * 4 * 4
    for k, part in pdf.groupby("k"):
        part = part.sort_values("t")
        n, size = len(part), len(part) // 5
        for fold in range(4):
            cut = n - (4 - fold) * size
            for c in grid:
                cols = X[: c["n_lags"]]
                b, w = direct(part[cols].to_numpy()[:cut], part.y.to_numpy()[:cut], c["l2"])
                y = part.y.to_numpy()[cut : cut + size]
                e = y - b - part[cols].to_numpy()[cut : cut + size] @ w
                r = got[(k, c["candidate_id"], fold)]
                assert r.mse == pytest.approx(np.mean(e**2), rel=1e-8)
                assert r.r2 == pytest.approx(1 - np.sum(e**2) / np.sum((y - y.mean()) ** 2), rel=1e-7, abs=1e-9)


def test_tuning_picks_a_weak_penalty_on_real_signal(ar1):
    grid = tuning.grid(l2=[1e6, 1.0], n_lags=[1])
    best = tuning.tune_ridge(ar1, ["k"], "t", X, "y", grid, 5).collect()
    assert all(r.candidate_id == 1 and r.best_params["l2"] == 1.0 for r in best)


def test_equal_scores_go_to_the_first_candidate(ar1):
    grid = tuning.grid(l2=[1.0, 1.0], n_lags=[2])
    assert {r.candidate_id for r in tuning.tune_ridge(ar1, ["k"], "t", X, "y", grid, 5).collect()} == {0}


def test_series_without_folds_has_no_row(ar1):
    tiny = ar1.where("t < 8")
    grid = tuning.grid(l2=[1.0])
    assert tuning.fold_scores(tiny, ["k"], "t", X, "y", grid, 10).count() == 0
    assert {(r.candidate_id, r.cv_score) for r in tuning.tune_ridge(tiny, ["k"], "t", X, "y", grid, 10).collect()} == {(0, None)}


def test_tuned_scores(ar1):
    grid = tuning.grid(l2=[0.1, 1.0, 1e5], n_lags=[1, 2, 3])
    out = tuning.tuned_scores(ar1, ["k"], "t", X, "y", grid, 5).collect()
    assert len(out) == 5 and all(set(r.best_params) == {"l2", "n_lags"} and r.rmse < 1.3 for r in out)


def test_trials_keep_past_before_future(ar1):
    grid = tuning.grid(l2=[1.0, 2.0])
    rows = tuning.expand_trials(ar1, ["k"], "t", grid, 3)
    ends = rows.groupBy("k", "candidate_id", "fold").pivot("role", ["train", "test"]).agg(F.max("t").alias("hi"), F.min("t").alias("lo"))
    found = ends.collect()
    assert len(found) == 5 * 2 * 3 and all(r.train_hi < r.test_lo for r in found)


def test_run_trials_spreads_work(spark):
    def double(batches):
        for pdf in batches:
            yield pdf.assign(twice=pdf.candidate_id * 2)

    trials = spark.range(10).withColumnRenamed("id", "candidate_id").coalesce(1)
    out = tuning.run_trials(trials, double, "candidate_id long, twice long", parallelism=4)
    assert sorted(r.twice for r in out.collect()) == list(range(0, 20, 2))


def test_random_candidates_are_seeded():
    spec = dict(l2=("log", 0.001, 0.1), n_lags=("int", 1, 8), x=("float", 0, 1))
    a, b = (tuning.random_candidates(30, 5, **spec) for _ in range(2))
    assert a == b and a != tuning.random_candidates(30, 6, **spec)
    assert all(0.001 <= c["l2"] <= 0.1 and 1 <= c["n_lags"] <= 8 for c in a)


def test_random_search_equals_brute_force(ar1):
    trials = tuning.random_candidates(6, 1, l2=("log", 0.1, 1000.0), n_lags=("int", 1, 3))
    got = {r.k: r for r in tuning.random_search(ar1, ["k"], "t", X, "y", trials).collect()}
    for k, part in ar1.toPandas().groupby("k"):
        part = part.sort_values("t").reset_index(drop=True)
        n_train = len(part) - int(np.ceil(0.2 * len(part)))
        n_fit = n_train - int(np.ceil(0.2 * n_train))
        scores = []
        for c in trials:
            cols = X[: c["n_lags"]]
            b, w = direct(part[cols].to_numpy()[:n_fit], part.y.to_numpy()[:n_fit], c["l2"])
            y = part.y.to_numpy()[n_fit:n_train]
            scores.append(np.mean(abs(y - b - part[cols].to_numpy()[n_fit:n_train] @ w) / abs(y)))
        assert got[k].candidate_id == int(np.argmin(scores))
        assert got[k].validation_mape == pytest.approx(min(scores), rel=1e-8)


# ------------------------------------------------------------------ one tree model

def test_time_folds_are_contiguous(ar1):
    rows = ensemble.time_fold_column(ar1, ["k"], "t", 3).groupBy("k", "fold").agg(F.min("t").alias("a"), F.max("t").alias("z"), F.count("*").alias("n"))
    assert all(r.z - r.a + 1 == r.n for r in rows.collect()) and rows.count() == 15


def test_boosted_trees_and_grid(ar1):
    model = ensemble.fit_trees(ar1, X, "y", max_depth=2, n_trees=3)
    weights = ensemble.feature_importances(model, X)
    assert max(weights, key=lambda w: w["importance"])["feature"] == "y_lag1"
    pipeline = ensemble.cross_validated_trees(X, "y", max_depth=(1, 2), n_trees=(2,), k=2)
    table = ensemble.grid_table(pipeline.fit(ensemble.time_fold_column(ar1, ["k"], "t", 2)))
    assert {(r["maxDepth"], r["maxIter"]) for r in table} == {(1, 2), (2, 2)} and all(r["rmse"] > 0 for r in table)


def test_past_only_scores(ar1):
    out = ensemble.past_only_scores(ar1, ["k"], "t", X, "y", max_depth=(1,), n_trees=(2,), k=2).collect()
    assert [(r.max_depth, r.n_trees, r.fold) for r in out] == [(1, 2, 0), (1, 2, 1)] and all(r.rmse > 0 for r in out)


# ------------------------------------------------------------------ synthetic series

def test_copula_keeps_margins_and_correlation(spark):
    rng = np.random.default_rng(12)
    x = rng.gamma(2.0, size=20_000)
    pdf = pd.DataFrame({"id": np.arange(20_000), "x": x, "y": 2 * x + rng.normal(size=20_000), "z": rng.integers(0, 5, 20_000).astype(float)})
    df = spark.createDataFrame(pdf)
    panel = synth.synthetic_panel(df, ["x", "y", "z"], ["id"], 3, keep=["id"]).cache()
    assert {r.series: r["count"] for r in panel.groupBy("series").count().collect()} == {1: 20_000, 2: 20_000, 3: 20_000}
    drawn = panel.where("series > 1").toPandas()
    for c in ("x", "y", "z"):
        assert np.allclose(np.quantile(drawn[c], [0.1, 0.5, 0.9]), np.quantile(pdf[c], [0.1, 0.5, 0.9]), atol=0.15)
    want, got = (d[["x", "y", "z"]].rank().corr().to_numpy() for d in (pdf, drawn))
    assert np.allclose(want, got, atol=0.05)
    again = synth.synthetic_panel(df.repartition(3), ["x", "y", "z"], ["id"], 3, keep=["id"])
    a, b = (d.where("series = 2").toPandas().sort_values("id").x.to_numpy() for d in (panel, again))
    assert np.allclose(a, b, rtol=1e-6)


def test_copula_of_a_constant_column(spark):
    df = spark.range(100).select("id", F.lit(7.0).alias("x"), F.rand(1).alias("y"))
    out = synth.synthetic_panel(df, ["x", "y"], ["id"], 2)
    assert {r.x for r in out.select("x").distinct().collect()} == {7.0}
    with pytest.raises(ValueError):
        synth.fit_copula(df.where("id < 0"), ["x"])
