"""Bronze, silver and gold layers: one Parquet table per layer, partitioned by run."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_layer(
    df: DataFrame, base: str, runid: int | None = None, run_col: str = "runid", runs: Sequence[int] | None = None
) -> int:
    """Overwrite the runs present in `df` (or the one given) and leave the others alone.

    `runs` names all runs that this write stands for: one of them that has no rows now is
    emptied, whatever it held before. Rows are gathered by run, and Spark splits a large run
    into files of its target size. Returns the row count; it and the runs seen are observed
    during the write, so nothing is scanned twice.
    """
    rows = df if runid is None else df.withColumn(run_col, F.lit(int(runid)))
    asked = [int(runid)] if runid is not None else [int(r) for r in runs or ()]
    seen = Observation()
    counts = [F.count(F.when(F.col(run_col) == r, 1)).alias(f"run_{r}") for r in asked]
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), *counts)
    (
        rows.hint("rebalance", F.col(run_col))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(run_col)
        .parquet(base)
    )
    found = seen.get
    for r in asked:
        if not found[f"run_{r}"]:
            drop_folder(df.sparkSession, f"{base}/{run_col}={r}")
    return int(found["n"])


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the file system that the path names, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_layer(spark: SparkSession, base: str, runs: Sequence[int] | None = None, run_col: str = "runid") -> DataFrame:
    """A layer, pruned to the asked runs."""
    df = spark.read.parquet(base)
    return df if runs is None else df.where(F.col(run_col).isin([int(r) for r in runs]))


def stack_layers(parts: dict[int, DataFrame], run_col: str = "runid") -> DataFrame:
    """Bag union of per-run tables that lie at separate paths, tagged with their run."""
    tagged = [df.withColumn(run_col, F.lit(int(run))) for run, df in parts.items()]
    return functools.reduce(DataFrame.unionByName, tagged)
