"""Adaptive search: proposals, early stopping, and the search of many series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkseries.operators import features, search, tuning

AXES = {"l2": ("log", 0.001, 1000.0), "n_lags": ("int", 1, 8)}


def test_axis_values_cover_their_range():
    whole = [search.value_at(("int", 3, 6), u) for u in np.linspace(0, 1, 4001)]
    assert set(whole) == {3, 4, 5, 6} and min(whole.count(v) for v in set(whole)) >= 1000
    assert search.value_at(("log", 0.01, 100.0), 0.5) == pytest.approx(1.0)
    assert search.value_at(("float", -1.0, 3.0), 0.25) == 0.0


def test_densities_are_densities_and_draws_follow_them():
    centres = np.array([0.1, 0.15, 0.8])
    grid = (np.arange(4000) + 0.5) / 4000
    dense = np.exp(search._log_density(grid, centres))
    assert dense.mean() == pytest.approx(1.0, abs=1e-3)
    drawn = search._draw(centres, 20_000, np.random.default_rng(1))
    assert drawn.min() >= 0 and drawn.max() <= 1
    share = np.histogram(drawn, 10, (0, 1))[0] / 20_000
    assert np.allclose(share, dense.reshape(10, 400).mean(axis=1) / 10, atol=0.02)


def bowl(params, fold):
    """Least at l2 = 20 and n_lags = 6, a little different on every fold."""
    return (np.log10(params["l2"]) - np.log10(20)) ** 2 + 0.3 * (params["n_lags"] - 6) ** 2 + 0.01 * fold


def test_search_beats_random_at_equal_trials():
    adaptive, chance = [], []
    for seed in range(30):
        history = search.searched(AXES, bowl, 4, 6, 5, np.random.default_rng(seed))
        assert len(history) == 30
        adaptive.append(min(bowl(t.params, 0) for t in history))
        chance.append(min(bowl(c, 0) for c in tuning.random_candidates(30, seed, **AXES)))
    assert np.mean(adaptive) < 0.5 * np.mean(chance) and np.median(adaptive) < np.median(chance)


def test_poor_trials_stop_early_and_all_are_recorded():
    seen = []
    history = search.searched(AXES, lambda p, fold: seen.append(fold) or bowl(p, fold), 10, 3, 8, np.random.default_rng(2))
    assert len(history) == 24 and [t.round for t in history] == [r for r in range(3) for _ in range(8)]
    for r in range(3):
        folds = sorted(t.folds for t in history[8 * r : 8 * r + 8])
        assert folds == [2] * 4 + [4] * 2 + [8] + [10]
        done = [t for t in history[8 * r : 8 * r + 8] if not t.stopped]
        assert len(done) == 1 and done[0].score == min(t.score for t in history[8 * r : 8 * r + 8] if t.folds == 10)
    assert len(seen) == sum(t.folds for t in history) < 24 * 10
    best = history[search.best_trial(history)]
    assert best.folds == 10 and best.score == min(t.score for t in history if t.folds == 10)


def panel(spark, n=300):
    rng = np.random.default_rng(9)
    rows = []
    for key, weight in (("a", 0.8), ("b", 0.2)):
        value = 0.0
        for i in range(n):
            value = weight * value + rng.normal()
            rows.append((key, i, float(value)))
    rows += [("short", i, float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "key string, ts int, value double")
    return features.lag_table(df, ["key"], "ts", "value", lags=range(1, 9))


def test_each_series_is_searched_and_refitted(spark):
    names = features.lag_names("value", range(1, 9))
    table = panel(spark)
    args = (["key"], "ts", names, "value", AXES)
    trials = search.adaptive_trials(table, *args, k=5, rounds=3, per_round=4, seed=3).collect()
    assert all(sum(r.key == key for r in trials) == 12 for key in ("a", "b", "short"))
    again = search.adaptive_trials(table.repartition(3), *args, k=5, rounds=3, per_round=4, seed=3).collect()
    strip = lambda rows: sorted((r.key, r.trial, r.round, tuple(sorted(r.params.items())), r.folds, r.stopped) for r in rows)
    assert strip(trials) == strip(again)
    assert strip(search.adaptive_trials(table, *args, k=5, rounds=3, per_round=4, seed=4).collect()) != strip(trials)

    out = {r.key: r for r in search.adaptive_search(table, *args, k=5, rounds=3, per_round=4, seed=3).collect()}
    assert set(out) == {"a", "b", "short"} and out["short"].cv_score is None and out["short"].trial == 0
    # The same parameters as the only candidate of a grid give the same scores.
    for key in ("a", "b"):
        r = out[key]
        one = tuning.tuned_scores(table.where(F.col("key") == key), ["key"], "ts", names, "value", [{"candidate_id": 0, **r.best_params}], 5).first()
        assert (one.n_rows, one.rmse, one.mape, one.cv_score) == (r.n_rows, pytest.approx(r.rmse), pytest.approx(r.mape), pytest.approx(r.cv_score))
