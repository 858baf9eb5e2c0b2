"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# A decimal number between any white space.  A Spark cast alone would also read Java literals
# (``1d``, ``0x1p3``) and keep NaN as a value; none of them is a number here.
_DECIMAL = r"([+-]?(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?|[+-]?(?i:inf(?:inity)?))"
_NUMBER = rf"(?U)^\s*+{_DECIMAL}\s*+$"


def number(c: Column, text: bool = True) -> Column:
    """Double of a text number, null for anything else, NaN included.

    The input is named once only, so the optimizer may copy the expression into filters.
    """
    if not text:
        value = c.cast("double")
        return F.when(~F.isnan(value), value)
    return F.regexp_extract(c, _NUMBER, 1).try_cast("double")


def rounded_product(a: Column, b: Column) -> Column:
    """Product of two doubles to four places, ties to even."""
    return F.bround(a * b, 4)


def rate(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, with an empty whole counted as one row."""
    return part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")


def at_scale(c: Column, precision: int, scale: int) -> Column:
    """Decimal of the given scale, ties away from zero; a value that does not fit ends the job.

    A null here would drop out of a sum unseen.
    """
    fitted = c.try_cast(f"decimal({precision},{scale})")
    too_large = F.raise_error(F.concat(F.lit(f"does not fit decimal({precision},{scale}): "), c.cast("string")))
    return F.when(c.isNull() | fitted.isNotNull(), fitted).otherwise(too_large.cast(f"decimal({precision},{scale})"))
