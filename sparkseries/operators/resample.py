"""Resampling to a coarser time grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.functions.timegrid import bucket


def resample(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    aggs: dict[str, Column] | str,
    unit: str = "hour",
) -> DataFrame:
    """One row per series and time bucket.

    `aggs` maps output names to aggregates; a plain column name means its mean. Each task
    aggregates before the shuffle, so a series or bucket that holds most of the input still
    sends one row per task. Buckets without input stay absent.
    """
    if isinstance(aggs, str):
        aggs = {aggs: F.avg(aggs)}
    return (
        df.withColumn("_bucket", bucket(df, ts, unit))
        .groupBy(*keys, F.col("_bucket").alias(ts))
        .agg(*[agg.alias(name) for name, agg in aggs.items()])
    )
