"""Data-quality expectations: how many rows pass and fail each rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expect(df: DataFrame, dataset: str, rules: dict[str, str]) -> DataFrame:
    """(dataset, expectation, passing_records, failing_records), one row per rule.

    All rules are counted in one pass. A rule that is null for a row counts as failing.
    """
    names = list(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.expr(rules[n])).alias(f"_r{i}") for i, n in enumerate(names)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("expectation"),
                F.col(f"_r{i}").alias("passing_records"),
                (F.col("_all") - F.col(f"_r{i}")).alias("failing_records"),
            )
            for i, n in enumerate(names)
        ]
    )
    return counts.select(F.lit(dataset).alias("dataset"), F.inline(rows))


def summarize(results: DataFrame) -> DataFrame:
    """Passing and failing records summed by rule and dataset."""
    return results.groupBy("dataset", "expectation").agg(
        F.sum("passing_records").alias("passing_records"),
        F.sum("failing_records").alias("failing_records"),
    )
