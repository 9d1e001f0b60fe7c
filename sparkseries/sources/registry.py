"""Run log and model registry as plain Parquet tables."""

from __future__ import annotations

import datetime
import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.sources.snapshots import history, last_version, read_snapshot, write_snapshot

RUN_LOG = "experiment string, run_id string, kind string, key string, value string, logged_at timestamp"


def log_run(
    spark: SparkSession, path: str, experiment: str, run_id: str, params: dict | None = None, metrics: dict | None = None
) -> None:
    """Append the parameters and metrics of one run, known to the driver, in long form."""
    now = datetime.datetime.now(datetime.timezone.utc)
    rows = [
        (experiment, run_id, kind, key, str(value), now)
        for kind, values in (("param", params), ("metric", metrics))
        for key, value in (values or {}).items()
    ]
    spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(path)


def long_runs(
    df: DataFrame, experiment: str, run_id: str, params: Sequence[str] = (), metrics: Sequence[str] = ()
) -> DataFrame:
    """Run-log rows from a table with one row per run, without passing through the driver."""
    entries = [
        F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
        for kind, cols in (("param", params), ("metric", metrics))
        for c in cols
    ]
    return df.select(
        F.lit(experiment).alias("experiment"), F.col(run_id).cast("string").alias("run_id"),
        F.inline(F.array(*entries)), F.current_timestamp().alias("logged_at"),
    )


def append_runs(runs: DataFrame, path: str) -> None:
    """Append rows in run-log form."""
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)


def run_table(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per run with a column per named key: the value that was logged last."""
    when = F.coalesce("logged_at", F.timestamp_seconds(F.lit(0)))  # logs of before it was kept
    return runs.groupBy("experiment", "run_id").pivot("key", list(keys)).agg(F.max_by("value", when))


def schema_signature(inputs: DataFrame, outputs: DataFrame) -> dict[str, str]:
    """Input and output schema of a model, as stored next to it."""
    return {"inputs": inputs.schema.json(), "outputs": outputs.schema.json()}


def check_signature(df: DataFrame, schema_json: str) -> None:
    """Fail when `df` lacks a column of the stored schema or holds it in another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for field in T.StructType.fromJson(json.loads(schema_json)).fields:
        if have.get(field.name) != field.dataType:
            found = have.get(field.name)
            raise ValueError(f"column {field.name}: expected {field.dataType}, found {found}")


def register_model(
    spark: SparkSession, base: str, name: str, model: PipelineModel | DataFrame, signature: dict[str, str] | None = None
) -> int:
    """Save the next version of a model under a name and return the version.

    A model is a fitted ML pipeline, or a DataFrame with one model row per series.
    """
    root = f"{base}/{name}"
    if isinstance(model, DataFrame):
        return write_snapshot(model, root, "REGISTER", kind="table", signature=signature or {})
    last = last_version(spark, root)
    version = 0 if last is None else last + 1
    model.write().overwrite().save(f"{root}/pipelines/{version}")
    marker = spark.range(1).select(F.lit("pipeline").alias("kind"))
    return write_snapshot(marker, root, "REGISTER", kind="pipeline", signature=signature or {})


def model_signature(spark: SparkSession, base: str, name: str) -> dict[str, str]:
    """Signature stored with the newest version."""
    newest = history(spark, f"{base}/{name}").first()
    return json.loads(newest["operationParameters"]["signature"])


def checked_model(spark: SparkSession, base: str, name: str, inputs: DataFrame):
    """Newest version of a model, after `inputs` was checked against its stored signature."""
    signature = model_signature(spark, base, name)
    if "inputs" in signature:
        check_signature(inputs, signature["inputs"])
    return latest_model(spark, base, name)


def latest_model(spark: SparkSession, base: str, name: str):
    """Newest version of a model: a DataFrame or a fitted pipeline."""
    root = f"{base}/{name}"
    newest = history(spark, root).first()
    if newest is None:
        raise FileNotFoundError(f"no model {name}")
    if json.loads(newest["operationParameters"]["kind"]) == "table":
        return read_snapshot(spark, root, newest["version"])
    return PipelineModel.load(f"{root}/pipelines/{newest['version']}")
