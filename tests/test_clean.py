import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkseries.functions import bucket, parse_decimal, parse_timestamp
from sparkseries.operators import clean
from sparkseries.operators.resample import resample


def test_bad_text_becomes_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    raw = spark.createDataFrame(
        [(1, "16/12/2006", "17:24:00", "4,216"), (1, "1/1/2007", "00:00:00", "?"), (1, "x", "y", None), (1, None, None, "1.5z")],
        "cust_id int, Date string, Time string, power string",
    )
    out = clean.clean_readings(raw, ["cust_id"], "Date", "Time", "power")
    assert out.dtypes == [("cust_id", "int"), ("ts", "timestamp"), ("power", "float")]
    rows = out.collect()
    assert rows[0].ts == dt.datetime(2006, 12, 16, 17, 24) and rows[0].power == pytest.approx(4.216, abs=1e-6)
    assert rows[1].ts == dt.datetime(2007, 1, 1) and rows[1].power is None
    assert rows[2].ts is None and rows[2].power is None
    assert rows[3].ts is None and rows[3].power is None


def test_expressions_compose(spark):
    row = spark.range(1).select(
        parse_timestamp(F.lit("2/3/2020"), F.lit("01:02:03")).alias("ts"),
        parse_decimal(F.lit("-1,25"), "double").alias("v"),
    ).first()
    assert row.ts == dt.datetime(2020, 3, 2, 1, 2, 3) and row.v == -1.25


def test_to_series_tolerates_text_dates(spark):
    raw = spark.createDataFrame([("1981-01-01", "20.7"), ("note", "x"), ("1981-01-03", "?")], "date string, t string")
    out = clean.complete_rows(clean.to_series(raw, "date", "t")).collect()
    assert [(r.ds, r.y) for r in out] == [(dt.date(1981, 1, 1), 20.7)]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
def test_between_dates_keeps_both_ends(spark, kind):
    days = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2020-01-05')) AS d")
    shift = F.expr("INTERVAL 23 HOURS") if kind.startswith("timestamp") else None
    col = F.col("d").cast(kind)
    df = days.select((col + shift if shift is not None else col).alias("d"))
    assert clean.between_dates(df, "d", "2020-01-02", "2020-01-04").count() == 3


def test_drop_trailer(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    assert sorted(r.id for r in clean.drop_trailer(df, "id", 2).collect()) == list(range(8))
    assert clean.drop_trailer(df, "id", 0).count() == 10


def test_complete_rows_drops_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "k int, v double")
    assert [r.k for r in clean.complete_rows(df).collect()] == [1]


def test_bucket_keeps_type_and_null(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 3, 5, 17, 59, 58, 7),), (None,), (dt.datetime(1969, 12, 31, 23, 59, 59),)], "ts timestamp_ntz"
    )
    for unit, want in {
        "second": dt.datetime(2024, 3, 5, 17, 59, 58),
        "minute": dt.datetime(2024, 3, 5, 17, 59),
        "hour": dt.datetime(2024, 3, 5, 17),
        "day": dt.datetime(2024, 3, 5),
        "week": dt.datetime(2024, 3, 4),
        "month": dt.datetime(2024, 3, 1),
        "year": dt.datetime(2024, 1, 1),
    }.items():
        out = df.select(bucket(df, "ts", unit).alias("b"))
        assert out.dtypes == [("b", "timestamp_ntz")]
        got = [r.b for r in out.collect()]
        assert got[0] == want and got[1] is None
        if unit == "hour":
            assert got[2] == dt.datetime(1969, 12, 31, 23)


def test_bucket_is_free_of_the_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 2, 30),)], "ts timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")  # 02:30 does not exist there
        assert df.select(bucket(df, "ts", "hour")).first()[0] == dt.datetime(2024, 3, 31, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_bucket_rejects_wrong_units(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "d date, n int")
    with pytest.raises(ValueError):
        bucket(df, "d", "hour")
    with pytest.raises(TypeError):
        bucket(df, "n", "day")
    with pytest.raises(ValueError):
        bucket(df, "d", "fortnight")


def test_resample_means_ignore_nulls_and_keep_null_hours(spark):
    t = dt.datetime
    df = spark.createDataFrame(
        [("a", t(2024, 1, 1, 0, 5), 1.0), ("a", t(2024, 1, 1, 0, 50), 3.0), ("a", t(2024, 1, 1, 1), None), ("b", None, 5.0)],
        "k string, ts timestamp_ntz, v double",
    )
    got = {(r.k, r.ts): r.v for r in resample(df, ["k"], "ts", "v", "hour").collect()}
    assert got == {("a", t(2024, 1, 1, 0)): 2.0, ("a", t(2024, 1, 1, 1)): None, ("b", None): 5.0}


def test_resample_aggregates_before_the_shuffle(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    plan = resample(events, ["event_type"], "ts", "value")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_avg") > plan.index("Exchange")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
