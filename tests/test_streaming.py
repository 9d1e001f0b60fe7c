import datetime as dt

from sparkseries.operators import quality
from sparkseries.operators.resample import resample
from sparkseries.streaming import stream_expectations, stream_resample


def readings(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t + dt.timedelta(minutes=20 * i), float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    return df, spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))


def run(stream, name, mode):
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(60)
    return stream.sparkSession.table(name)


def test_stream_resample_equals_batch(spark, tmp_path):
    batch, stream = readings(spark, tmp_path)
    got = {r.ts: r.v for r in run(stream_resample(stream, ["k"], "ts", "v"), "hours", "append").collect()}
    want = {r.ts: r.v for r in resample(batch, ["k"], "ts", "v").collect()}
    assert got and all(want[h] == v for h, v in got.items())
    assert len(want) - len(got) <= 3  # the newest hours wait for the watermark


def test_stream_expectations_equal_batch(spark, tmp_path):
    batch, stream = readings(spark, tmp_path)
    rules = {"big": "v > 10"}
    got = run(stream_expectations(stream, "d", rules), "checks", "complete").collect()
    assert got == quality.expect(batch, "d", rules).collect()


def test_stream_weeks_start_on_monday(spark, tmp_path):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 10, 5), 1.0), ("a", dt.datetime(2024, 3, 1), 1.0)], "k string, ts timestamp_ntz, v double")
    df.coalesce(1).write.parquet(str(tmp_path / "weeks"))
    stream = stream_resample(spark.readStream.schema(df.schema).parquet(str(tmp_path / "weeks")), ["k"], "ts", "v", "week")
    got = {r.ts for r in run(stream, "weeks", "append").collect()}
    assert dt.datetime(2024, 1, 8) in {r.ts for r in resample(df, ["k"], "ts", "v", "week").collect()} and got <= {dt.datetime(2024, 1, 8), dt.datetime(2024, 2, 26)} and got
