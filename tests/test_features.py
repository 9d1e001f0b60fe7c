import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkseries.operators import features
from sparkseries.operators.rank import split_blocks, with_position


def hours(spark, values, series="a", skip=()):
    start = dt.datetime(2024, 1, 1)
    rows = [(series, start + dt.timedelta(hours=i), v) for i, v in enumerate(values) if i not in skip]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")


def test_lags_count_rows_over_gaps(spark):
    out = features.lag_features(hours(spark, [0.0, 1.0, 2.0, 3.0], skip=[2]), ["k"], "ts", "v", [1, 2]).orderBy("ts").collect()
    assert [(r.v, r.v_lag1, r.v_lag2) for r in out] == [(0.0, None, None), (1.0, 0.0, None), (3.0, 1.0, 0.0)]


def test_lag_table_of_short_and_null_series(spark):
    df = hours(spark, [1.0]).unionByName(hours(spark, [None, None, None], "n"))
    assert features.lag_table(df, ["k"], "ts", "v", [1]).count() == 0


def test_eight_lags_share_one_window(spark, sf):
    from sparkseries.operators.resample import resample

    hourly = resample(spark.read.parquet(f"{sf}/events.parquet"), ["event_type"], "ts", "value")
    plan = features.lag_features(hourly, ["event_type"], "ts", "value")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window [") == 1


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k, n in (("hot", 700), ("b", 40), (None, 30), ("one", 1)):
        at = np.sort(rng.choice(20_000, n, replace=False))
        rows += [(k, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=int(m)), float(rng.normal())) for m in at]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double").cache()


def day():
    return F.to_date("ts")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_blocked_position_equals_plain(panel):
    cols = ("k", "ts", "pos", "n")
    plain = with_position(panel, ["k"], ["ts"], total="n")
    for chunk in (50, 1_000_000):
        blocked = with_position(panel, ["k"], ["ts"], total="n", block=day(), chunk_rows=chunk)
        assert rows(plain, *cols) == rows(blocked, *cols)


def test_blocked_lags_and_averages_equal_plain(panel):
    plain = features.lag_features(panel, ["k"], "ts", "v", [1, 7, 24])
    blocked = features.lag_features(panel, ["k"], "ts", "v", [1, 7, 24], block=day(), chunk_rows=32)
    cols = ("k", "ts", "v", "v_lag1", "v_lag7", "v_lag24")
    assert rows(plain, *cols) == rows(blocked, *cols)
    for centred in (True, False):
        plain = features.moving_average(panel, ["k"], "ts", "v", 9, centred)
        blocked = features.moving_average(panel, ["k"], "ts", "v", 9, centred, block=day(), chunk_rows=16)
        a, b = (d.toPandas().sort_values(["k", "ts"]).smooth.to_numpy() for d in (plain, blocked))
        assert np.allclose(a, b, rtol=0, atol=1e-12)


@pytest.mark.parametrize("chunk", [1, 3, 40, 10_000])
def test_chunks_shorter_than_the_reach(panel, chunk):
    """A lag of 100 rows reaches over many chunks; so does a wide centred average."""
    cols = ("k", "ts", "v", "v_lag1", "v_lag100")
    plain = features.lag_features(panel, ["k"], "ts", "v", [1, 100])
    blocked = features.lag_features(panel, ["k"], "ts", "v", [1, 100], block=F.date_trunc("hour", "ts"), chunk_rows=chunk)
    assert rows(plain, *cols) == rows(blocked, *cols)
    plain = features.moving_average(panel, ["k"], "ts", "v", 61)
    blocked = features.moving_average(panel, ["k"], "ts", "v", 61, block=day(), chunk_rows=chunk)
    a, b = (d.toPandas().sort_values(["k", "ts"]).smooth.to_numpy() for d in (plain, blocked))
    assert len(a) == len(b) and np.allclose(a, b, rtol=0, atol=1e-12)


@pytest.mark.parametrize("alpha", [0.02, 0.1, 0.5, 0.9, 0.99, 1.0])
@pytest.mark.parametrize("blocked", [False, True])
def test_ema_equals_pandas(panel, alpha, blocked):
    out = features.ema(panel, ["k"], "ts", "v", alpha, block=day() if blocked else None).toPandas()
    for _, part in out.groupby("k", dropna=False):
        part = part.sort_values("ts")
        want = part.v.ewm(alpha=alpha, adjust=False).mean()
        assert np.allclose(part.ema, want, rtol=1e-9, atol=1e-12)


def test_ema_skips_nulls(spark):
    out = features.ema(hours(spark, [None, 1.0, None, 2.0]), ["k"], "ts", "v", 0.5).orderBy("ts").collect()
    assert [r.ema for r in out] == [None, 1.0, None, 1.5]


def test_ema_of_a_long_run_does_not_overflow(spark):
    n = 30_000
    df = spark.range(n).select(F.lit("a").alias("k"), F.col("id").alias("ts"), (F.col("id") % 17).cast("double").alias("v"))
    got = features.ema(df, ["k"], "ts", "v", 0.1).orderBy("ts").toPandas().ema
    want = pd.Series([i % 17 for i in range(n)], dtype=float).ewm(alpha=0.1, adjust=False).mean()
    assert np.allclose(got, want, rtol=1e-10)


def test_moving_average_shortens_at_the_ends(spark):
    df = hours(spark, [1.0, 2.0, 3.0, 4.0, 5.0])
    assert [r.smooth for r in features.moving_average(df, ["k"], "ts", "v", 3).orderBy("ts").collect()] == [1.5, 2, 3, 4, 4.5]
    trailing = features.moving_average(df, ["k"], "ts", "v", 3, centred=False)
    assert [r.smooth for r in trailing.orderBy("ts").collect()] == [1, 1.5, 2, 3, 4]


def test_feature_vector(spark):
    out = features.feature_vector(spark.createDataFrame([(1.0, 2.0)], "a double, b double"), ["a", "b"])
    assert list(out.first().features) == [1.0, 2.0]


def test_blocked_windows_see_files_added_between_calls(spark, tmp_path):
    """Counts of an earlier call on the same path are not used again."""
    path = str(tmp_path / "readings")
    make = lambda lo: spark.range(lo, lo + 100).select(F.lit("a").alias("k"), F.col("id").alias("t"), F.col("id").alias("v"))
    for round_, want in ((0, 100), (1, 200)):
        make(100 * round_).write.mode("append").parquet(path)
        df = spark.read.parquet(path)
        block = F.floor(F.col("t") / 10)
        assert with_position(df, ["k"], ["t"], block=block).where("pos = t + 1").count() == want
        assert features.lag_features(df, ["k"], "t", "v", [1], block=block, chunk_rows=30).where("v_lag1 = v - 1 OR t = 0").count() == want


@pytest.mark.parametrize("chunk", [7, 50])
def test_one_block_is_split(spark, chunk):
    """All rows of a series in one block: positions, lags and labels are those of the plain form."""
    df = spark.range(500).select(F.when(F.col("id") < 450, "a").otherwise("b").alias("k"), (F.col("id") * 37 % 500).alias("t")).withColumn("v", F.col("t") * 2)
    same = F.lit(1)
    assert rows(with_position(df, ["k"], ["t"], total="n"), "k", "t", "pos", "n") == rows(
        with_position(df, ["k"], ["t"], total="n", block=same, chunk_rows=chunk), "k", "t", "pos", "n")
    parts = split_blocks(df.withColumn("_block", same), ["k"], ["t"], chunk).groupBy("k", "_block").count()
    assert parts.agg(F.max("count")).first()[0] < 4 * chunk and parts.count() > 5
    plain = features.lag_features(df, ["k"], "t", "v", [1, 12])
    blocked = features.lag_features(df, ["k"], "t", "v", [1, 12], block=same, chunk_rows=chunk)
    assert rows(plain, "k", "t", "v_lag1", "v_lag12") == rows(blocked, "k", "t", "v_lag1", "v_lag12")
