"""Column expressions: every function maps Columns to Columns and compiles to native Spark SQL."""

from veritill.functions.dates import as_timestamp, parse_timestamp, tenure_days, whole_days
from veritill.functions.numbers import at_scale, number, rate, rounded_product
from veritill.functions.text import (
    capitalise_words,
    decimal_text,
    flag,
    grouped_text,
    lookup,
    lower_strip,
    normalise_status,
    strip,
    title_case,
)

__all__ = [
    "as_timestamp",
    "at_scale",
    "capitalise_words",
    "decimal_text",
    "flag",
    "grouped_text",
    "lookup",
    "lower_strip",
    "normalise_status",
    "number",
    "parse_timestamp",
    "rate",
    "rounded_product",
    "strip",
    "tenure_days",
    "title_case",
    "whole_days",
]
