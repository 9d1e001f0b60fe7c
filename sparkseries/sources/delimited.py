"""Delimited text: raw scans and forecast export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_text_columns(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, sep: str = ";"
) -> DataFrame:
    """Every column as text, typed later by tolerant casts.

    With `columns` (all columns of the file, in order) no job runs to find the header; a file
    whose header has other names, or another order, fails. Without it Spark reads the first line
    for the names.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("enforceSchema", False)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def read_inferred(spark: SparkSession, path: str, schema: str | T.StructType | None = None, sep: str = ",") -> DataFrame:
    """Typed scan. A given schema saves the extra pass that inference takes; text that does not
    fit it becomes null, a header that does not fit it fails."""
    reader = spark.read.option("header", True).option("sep", sep).option("enforceSchema", False)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("mode", "PERMISSIVE").csv(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Export with a header, one file per task."""
    (df.select(*columns) if columns else df).write.mode("overwrite").option("header", True).csv(path)
