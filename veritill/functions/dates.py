"""Date and time expressions.  Timestamps are UTC; run with a UTC session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritill.model import DATE_SHAPE


def parse_timestamp(c: Column, shape: str = DATE_SHAPE) -> Column:
    """Timestamp of a text of the declared shape between any white space, else null.

    Matching the shape and casting is faster than a formatter, and raises nothing inside.
    """
    return F.regexp_extract(c, rf"(?U)^\s*+({shape})\s*+$", 1).try_cast("timestamp")


def as_timestamp(value: str | datetime | Column) -> Column:
    """Timestamp column of an explicit "now" (text, datetime or column)."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(value).cast("timestamp")


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed days, rounded toward zero; null when either end is null."""
    return F.timestamp_diff("DAY", start, end)


def tenure_days(start: Column, end: Column) -> Column:
    """Whole elapsed days, never below zero; null when either end is null."""
    days = whole_days(start, end)
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0))).cast("int")
