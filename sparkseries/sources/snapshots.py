"""Tables that keep their earlier versions.

Each write is a new Parquet folder `version=n`; an appended history row publishes it. A write
that fails before the history row is never seen by a reader.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY = "version long, timestamp timestamp, operation string, operationParameters map<string,string>"


def _history_rows(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(HISTORY).parquet(f"{path}/history")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], HISTORY)


def history(spark: SparkSession, path: str) -> DataFrame:
    """(version, timestamp, operation, operationParameters), newest first."""
    return _history_rows(spark, path).orderBy(F.desc("version"))


def last_version(spark: SparkSession, path: str) -> int | None:
    """Number of the newest published version; runs a small job."""
    return _history_rows(spark, path).agg(F.max("version")).first()[0]


def write_snapshot(df: DataFrame, path: str, operation: str = "WRITE", **parameters) -> int:
    """Write the next version and return its number. One writer at a time per path."""
    spark = df.sparkSession
    last = last_version(spark, path)
    version = 0 if last is None else last + 1
    df.write.mode("overwrite").parquet(f"{path}/data/version={version}")
    noted = {"mode": "Overwrite", **{k: json.dumps(v) for k, v in parameters.items()}}
    entry = spark.range(1).select(
        F.lit(version).cast("long").alias("version"),
        F.current_timestamp().alias("timestamp"),
        F.lit(operation).alias("operation"),
        F.create_map(*[F.lit(x) for pair in noted.items() for x in pair]).alias("operationParameters"),
    )
    entry.coalesce(1).write.mode("append").parquet(f"{path}/history")
    return version


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or an earlier one."""
    if version is None:
        version = last_version(spark, path)
        if version is None:
            raise FileNotFoundError(f"no published version under {path}")
    return spark.read.parquet(f"{path}/data/version={version}")
