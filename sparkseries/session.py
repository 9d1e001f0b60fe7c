"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "sparkseries", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Session with the settings the operators are written for; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def cut_lineage(df: DataFrame, fallback_dir: str | None = None) -> DataFrame:
    """Checkpoint to the cluster's shared folder (`spark.checkpoint.dir`); runs a job.

    `fallback_dir` is used only where the session names no folder, as in tests.
    """
    spark = df.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None)
    target = shared or fallback_dir
    if target is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(target)
    return df.checkpoint(eager=True)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Rows for a loop of jobs that all read them.

    Where the cluster names a shared checkpoint folder the rows are written there once, so a
    lost executor costs no recomputation in the middle of the loop. Otherwise they are kept in
    memory and on disk, and released at the end.
    """
    if df.sparkSession.conf.get("spark.checkpoint.dir", None):
        yield cut_lineage(df)
        return
    rows = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()
