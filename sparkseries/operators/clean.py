"""Cleaning: from raw text columns to a typed long panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.functions.text import READING_FORMAT, parse_decimal, parse_timestamp, to_number

# A trailer of at most this many rows is broadcast; a longer one is joined by key.
TRAILER_BROADCAST_ROWS = 10_000


def clean_readings(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    time: str,
    value: str,
    ts: str = "ts",
    fmt: str = READING_FORMAT,
    dtype: str = "float",
) -> DataFrame:
    """(keys, ts, value) from date text, time text and value text. One narrow stage, no sort."""
    return df.select(
        *keys,
        parse_timestamp(F.col(date), F.col(time), fmt).alias(ts),
        parse_decimal(F.col(value), dtype).alias(value),
    )


def as_date(df: DataFrame, date: str) -> Column:
    """The day of a column; bad text gives null instead of an error."""
    col = F.col(date)
    return col.try_cast("date") if dict(df.dtypes)[date] == "string" else col.cast("date")


def to_series(df: DataFrame, date: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, ds, y) with an explicit date and a tolerant double."""
    return df.select(*keys, as_date(df, date).alias("ds"), to_number(F.col(value)).alias("y"))


def between_dates(df: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """Rows from the day `start` to the day `end`, both included.

    The bounds are literals of the column's own kind, so the filter reaches the file scan.
    """
    dtype = dict(df.dtypes)[date]
    if dtype == "date":
        return df.where(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if dtype == "string":
        return df.where(as_date(df, date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    kind = "timestamp_ntz" if dtype == "timestamp_ntz" else "timestamp"
    after = F.date_add(F.lit(end).cast("date"), 1).cast(kind)
    return df.where((F.col(date) >= F.lit(start).cast(kind)) & (F.col(date) < after))


def complete_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with no null and no NaN."""
    return df.dropna("any", subset=list(subset) if subset else None)


def drop_trailer(df: DataFrame, key: str, k: int) -> DataFrame:
    """All rows but the `k` last by `key`, which must be unique.

    The trailer is a top-k (each task keeps k rows), removed by an anti join, so the table is
    never numbered in one task.
    """
    trailer = df.select(key).orderBy(F.desc(key)).limit(k)
    if k <= TRAILER_BROADCAST_ROWS:
        trailer = F.broadcast(trailer)
    return df.join(trailer, key, "left_anti")


def to_long(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "measure", value: str = "value"
) -> DataFrame:
    """One row per id and measure, as multi-line charts want it."""
    return df.unpivot(list(ids), list(values), name, value)
