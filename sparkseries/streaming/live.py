"""Structured Streaming forms of `resample` and `expect`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.operators.quality import expect


def stream_resample(
    df: DataFrame, keys: Sequence[str], ts: str, aggs: dict[str, Column] | str, unit: str = "hour", late: str = "2 hours"
) -> DataFrame:
    """One row per series and hour (or other fixed unit) of a stream.

    Readings may arrive up to `late` after newer ones; state of older buckets is dropped. In
    append mode a bucket is emitted once, when the watermark has passed its end. Event time must
    be a timestamp with time zone in Spark; one without is read in the session zone (use UTC).
    Weeks start on Monday, as in `resample`; a row without a time has no bucket and is left out.
    """
    if unit not in ("second", "minute", "hour", "day", "week"):
        raise ValueError("a stream needs a unit of fixed length")
    if isinstance(aggs, str):
        aggs = {aggs: F.avg(aggs)}
    kind = dict(df.dtypes)[ts]
    # Day 0 of the clock was a Thursday: weeks are shifted to Monday.
    span = F.window(ts, "1 week", "1 week", "4 days") if unit == "week" else F.window(ts, f"1 {unit}")
    out = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(*keys, span.alias("_w")).agg(*[a.alias(n) for n, a in aggs.items()])
    return out.select(*keys, F.col("_w.start").cast(kind).alias(ts), *aggs)


def stream_expectations(df: DataFrame, dataset: str, rules: dict[str, str]) -> DataFrame:
    """Running pass and fail counts of a stream; write it in complete mode."""
    return expect(df, dataset, rules)
