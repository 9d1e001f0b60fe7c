"""Local regression against a plain Python form."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkseries.operators.smoothing import local_regression


def by_hand(x, y, span, robust):
    x, y = np.asarray(x, float), np.asarray(y, float)
    trust = np.ones(len(x))
    for _ in range(robust + 1):
        fit = []
        for i in range(len(x)):
            inside = range(max(0, i - span + 1), min(len(x), i + span))
            near = sorted(inside, key=lambda j: (abs(x[j] - x[i]), x[j], y[j]))[:span]
            d = np.abs(x[near] - x[i])
            w = ((1 - (d / d.max()) ** 3) ** 3 if d.max() > 0 else np.ones(len(d))) * trust[near]
            if w.sum() == 0:
                fit.append(np.nan)
                continue
            mx, my = (w * x[near]).sum() / w.sum(), (w * y[near]).sum() / w.sum()
            sxx = (w * (x[near] - mx) ** 2).sum()
            fit.append(my + ((w * (x[near] - mx) * (y[near] - my)).sum() / sxx if sxx else 0.0) * (x[i] - mx))
        off = np.abs(y - np.array(fit))
        s = np.median(off)
        trust = np.where(off < 6 * s, (1 - (off / (6 * s)) ** 2) ** 2, 0.0) if s > 0 else (off == 0).astype(float)
    return np.array(fit)


@pytest.mark.parametrize("span, robust", [(2, 0), (5, 0), (10, 2), (60, 1)])
def test_local_regression_equals_the_plain_form(spark, span, robust):
    rng = np.random.default_rng(span)
    rows, want = [], {}
    for key in ("a", "b", None):
        x = np.sort(rng.choice(200, 50, replace=False))
        y = np.sin(x / 20) + rng.normal(0, 0.2, 50) + 10 * (rng.random(50) < 0.04)
        rows += [(key, dt.date(2020, 1, 1) + dt.timedelta(int(i)), float(v), "old") for i, v in zip(x, y)]
        want[key] = by_hand(x, y, span, robust)
    df = spark.createDataFrame(rows, "key string, ds date, y double, smooth string").repartition(3)
    out = local_regression(df, ["key"], "ds", "y", span, robust)
    for key in want:
        got = [r.smooth for r in out.where(F.col("key").eqNullSafe(F.lit(key))).orderBy("ds").collect()]
        assert np.allclose([np.nan if v is None else v for v in got], want[key], atol=1e-8, equal_nan=True)


def test_robust_rounds_ignore_an_outlier_and_odd_rows_are_kept(spark):
    rows = [(i, 2.0 * i if i != 20 else 500.0) for i in range(40)] + [(None, 1.0), (7, None), (8, float("nan"))]
    df = spark.createDataFrame(rows, "t int, y double")
    plain, robust = (local_regression(df, [], "t", "y", 8, k) for k in (0, 2))
    assert robust.count() == 43 and robust.where("smooth IS NULL").count() == 3
    off = lambda out: out.where("t between 15 and 25 and y < 500 and smooth IS NOT NULL").select(F.max(F.abs(F.col("smooth") - 2 * F.col("t")))).first()[0]
    assert off(plain) > 50 and off(robust) < 1e-6
    one = spark.createDataFrame([(1, 5.0)], "t int, y double")
    assert local_regression(one, [], "t", "y").first().smooth == 5.0 and local_regression(one.limit(0), [], "t", "y").count() == 0
