import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkseries.operators import splits


def series(spark, n, k="a"):
    return spark.range(n).select(F.lit(k).alias("k"), F.expr("date_add(date'2020-01-01', cast(id as int))").alias("ds"), F.col("id").cast("double").alias("y"))


def test_holdout_last_is_ordered(spark):
    out = splits.holdout_last(series(spark, 10), ["k"], "ds", 3).collect()
    train = [r.ds for r in out if r.part == "train"]
    test = [r.ds for r in out if r.part == "test"]
    assert len(test) == 3 and max(train) < min(test)


def test_holdout_of_tiny_series(spark):
    out = splits.holdout_last(series(spark, 1).unionByName(series(spark, 2, "b")), ["k"], "ds", 48).collect()
    assert {r.part for r in out} == {"test"}


@pytest.mark.parametrize("n,want", [(1, 1), (5, 1), (6, 2), (10, 2), (11, 3)])
def test_fraction_rounds_up(spark, n, want):
    out = splits.holdout_fraction(series(spark, n), ["k"], "ds", 0.2)
    assert out.where("part = 'test'").count() == want


def test_fold_sizes(spark):
    out = splits.time_series_folds(series(spark, 23), ["k"], "ds", 10)
    counts = {(r.fold, r.role): r["count"] for r in out.groupBy("fold", "role").count().collect()}
    assert counts[(0, "train")] == 3
    assert all(counts[(i, "test")] == 2 and counts[(i, "train")] == 3 + 2 * i for i in range(10))
    ends = out.groupBy("fold").pivot("role", ["train", "test"]).agg(F.max("ds").alias("hi"), F.min("ds").alias("lo"))
    assert all(r.train_hi < r.test_lo for r in ends.collect())


def test_series_shorter_than_folds_has_none(spark):
    assert splits.time_series_folds(series(spark, 10), ["k"], "ds", 10).count() == 0
    assert splits.fold_segments(series(spark, 10), ["k"], "ds", 10).where("segment IS NOT NULL").count() == 0


def test_blocked_folds_equal_plain(spark):
    df = series(spark, 50).unionByName(series(spark, 23, "b"))
    month = F.trunc("ds", "month")
    a = splits.fold_segments(df, ["k"], "ds", 5)
    b = splits.fold_segments(df, ["k"], "ds", 5, block=month)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_cutoffs_match_their_rule(spark):
    df = series(spark, 1000)
    got = sorted(r.cutoff for r in splits.cutoffs(df, ["k"], "ds").collect())
    first, last = dt.date(2020, 1, 1), dt.date(2020, 1, 1) + dt.timedelta(999)
    want, c = [], last - dt.timedelta(90)
    while c >= first + dt.timedelta(700):
        want.append(c)
        c -= dt.timedelta(30)
    assert got == sorted(want)


@pytest.mark.parametrize("initial,period,horizon", [(20, 7, 10), (5, 3, 3), (10, 10, 4)])
def test_cutoff_folds_equal_brute_force(spark, initial, period, horizon):
    df = series(spark, 60).where("day(ds) % 5 != 0")
    days = sorted(r.ds for r in df.collect())
    one = dt.timedelta(1)
    want, c = set(), days[-1] - horizon * one
    while c >= days[0] + initial * one:
        want |= {(c, d, "train") for d in days if d <= c}
        want |= {(c, d, "test") for d in days if c < d <= c + horizon * one}
        c -= period * one
    for frame, keys in ((df, ["k"]), (df.drop("k"), [])):
        got = splits.cutoff_folds(frame, keys, "ds", initial, period, horizon).collect()
        assert len(got) == len(want) and {(r.cutoff, r.ds, r.role) for r in got} == want


def test_series_too_short_for_a_cutoff(spark):
    assert splits.cutoffs(series(spark, 100), ["k"], "ds").count() == 0
    assert splits.cutoff_folds(series(spark, 100), ["k"], "ds").count() == 0


def test_chart_frame(spark):
    df = series(spark, 300)
    predicted = splits.holdout_last(df, ["k"], "ds", 48).where("part = 'test'").withColumn("yhat", F.col("y"))
    out = splits.chart_frame(df, ["k"], "ds", "y", predicted)
    assert {r.part: r["count"] for r in out.groupBy("part").count().collect()} == {"train": 150, "test": 48, "forecast": 48}


def test_blocked_holdout_ranks_only_boundary_blocks(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"), F.col("id").cast("string").alias("raw"))
    block = F.floor(F.col("t") / 60)
    for blocked, plain in (
        (splits.holdout_last(df, ["k"], "t", 48, block=block), splits.holdout_last(df, ["k"], "t", 48)),
        (splits.holdout_fraction(df, ["k"], "t", 0.2, block=block), splits.holdout_fraction(df, ["k"], "t", 0.2)),
        (splits.fold_segments(df, ["k"], "t", 7, block=block), splits.fold_segments(df, ["k"], "t", 7)),
    ):
        assert sorted(map(tuple, blocked.collect())) == sorted(map(tuple, plain.collect()))
    out = splits.holdout_last(df, ["k"], "t", 48, block=block)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) <= 1  # the boundary blocks, for their ranking
