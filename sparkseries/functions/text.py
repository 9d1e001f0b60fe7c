"""Tolerant typing of raw text columns. Bad text gives null, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text format and missing-value marker of the raw readings.
READING_FORMAT = "d/M/yyyy HH:mm:ss"
MISSING_MARK = "?"


def parse_timestamp(date: Column, time: Column, fmt: str = READING_FORMAT) -> Column:
    """One timestamp from a date text and a time text."""
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit(fmt))


def parse_decimal(text: Column, dtype: str = "float", missing: str = MISSING_MARK) -> Column:
    """Number from text that may hold a decimal comma or the missing mark."""
    return F.when(text != missing, F.regexp_replace(text, ",", ".").try_cast(dtype))


def to_number(text: Column, dtype: str = "double") -> Column:
    """Number from text; whatever does not parse becomes null."""
    return text.try_cast(dtype)
