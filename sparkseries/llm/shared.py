"""Written tables that cut a plan, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; only where it is unset on a local master (tests) a
    local folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if "_llm_shared" not in spark.__dict__:
        spark._llm_shared = tempfile.mkdtemp(prefix="llm-shared-")
    return spark._llm_shared


def written(df: DataFrame, name: str = "table", keep: bool = False) -> DataFrame:
    """Write the rows once as Parquet in the shared folder and read them back.

    What follows neither recomputes them nor loses them with an executor. Runs a job. `swept`
    removes the table, unless it is to be kept.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    if not keep:
        spark.__dict__.setdefault("_llm_tables", []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Remove the tables written inside, but for kept ones, when what reads them has been written."""
    tables = spark.__dict__.setdefault("_llm_tables", [])
    before = len(tables)
    try:
        yield
    finally:
        for path in tables[before:]:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        del tables[before:]


def free_name(taken: list[str], wanted: str) -> str:
    """A column name that is not taken, whatever its case."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted
