"""Cleaning, quarantine and keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from veritill.functions import (
    as_timestamp,
    flag,
    lookup,
    lower_strip,
    normalise_status,
    number,
    parse_timestamp,
    rounded_product,
    strip,
    title_case,
)
from veritill.model import COUNTRY_ALIASES, CUSTOMER_KEY, REJECT_REASON, ROW_ID, TRANSACTION_KEY


class Split(NamedTuple):
    """Accepted and quarantined rows of one source; both are lazy."""

    clean: DataFrame
    rejected: DataFrame


# --------------------------------------------------------------------------- shared steps
def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def trim_text(df: DataFrame, besides: Sequence[str] = ()) -> DataFrame:
    """Strip every text column; other columns, and those named, pass through."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: strip(F.col(f"`{c}`")) for c in texts if c not in besides})


def _typed_number(df: DataFrame, column: str) -> Column:
    return number(F.col(column), text=_is_text(df, column))


def _typed_timestamp(df: DataFrame, column: str) -> Column:
    return parse_timestamp(F.col(column)) if _is_text(df, column) else F.col(column).cast("timestamp")


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """First row of every key in source order; null keys equal each other.

    ``row_number() = 1`` lets Spark drop all but one row per key and map task before the
    shuffle, so a key with many copies never gathers in one task.  A frame without ``_row_id``
    has no source order; all its other columns then decide, which is deterministic as well.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    order = list(order_by or ([ROW_ID] if ROW_ID in df.columns else others)) or list(keys)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).where(F.col("_nth") == 1).drop("_nth")


# --------------------------------------------------------------------------- transactions
def type_transactions(raw: DataFrame) -> DataFrame:
    """Trimmed text, parsed InvoiceDate, numeric UnitPrice and Quantity."""
    typed = {
        "InvoiceDate": _typed_timestamp(raw, "InvoiceDate"),
        "UnitPrice": _typed_number(raw, "UnitPrice"),
        "Quantity": _typed_number(raw, "Quantity"),
    }
    return trim_text(raw, besides=list(typed)).withColumns(typed)


def reject_rules(as_of) -> dict[str, Column]:
    """Predicates over typed transactions, in the order their labels are joined."""
    date, price, quantity = F.col("InvoiceDate"), F.col("UnitPrice"), F.col("Quantity")
    return {
        "bad_date": date.isNull(),
        "bad_unit_price": price.isNull(),
        "bad_quantity": quantity.isNull(),
        "negative_price": price < 0,
        "future_date": date > as_timestamp(as_of),
    }


def is_accepted(as_of) -> Column:
    """No rule failed.  A comparison with null is not true, so each column is named once."""
    return (
        (F.col("UnitPrice") >= 0) & (F.col("InvoiceDate") <= as_timestamp(as_of)) & F.col("Quantity").isNotNull()
    )


def with_reason(typed: DataFrame, as_of) -> DataFrame:
    """Every failed rule in ``_reject_reason``, empty for accepted rows."""
    labels = [F.when(failed, F.lit(label)) for label, failed in reject_rules(as_of).items()]
    return typed.withColumn(REJECT_REASON, F.concat_ws("|", *labels))


def rejected_transactions(typed: DataFrame, as_of) -> DataFrame:
    """The quarantined side; labels are only built for its rows."""
    refused = typed.where(~F.coalesce(is_accepted(as_of), F.lit(False)))
    return with_reason(refused, as_of).drop(ROW_ID)


def accepted_transactions(
    typed: DataFrame, as_of, order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """The accepted side, de-duplicated, normalised and with derived columns."""
    kept = keep_first(typed.where(is_accepted(as_of)), TRANSACTION_KEY, order_by).drop(ROW_ID)
    texts = {"Description": title_case, "Status": normalise_status}
    kept = kept.withColumns({c: step(F.col(c)) for c, step in texts.items() if c in kept.columns})
    return with_date_parts(with_line_total(kept))


def with_line_total(df: DataFrame) -> DataFrame:
    """C16."""
    return df.withColumn("LineTotal", rounded_product(F.col("Quantity"), F.col("UnitPrice")))


def with_date_parts(df: DataFrame) -> DataFrame:
    """C17: year, month, day of month and English weekday name."""
    date = F.col("InvoiceDate")
    return df.withColumns(
        {
            "TxYear": F.year(date),
            "TxMonth": F.month(date),
            "TxDay": F.dayofmonth(date),
            "TxDOW": F.date_format(date, "EEEE"),
        }
    )


def clean_transactions(raw: DataFrame, as_of, order_by: Sequence[str | Column] | None = None) -> Split:
    """Rejects leave before de-duplication, so a rejected row never shadows a good one."""
    typed = type_transactions(raw)
    return Split(accepted_transactions(typed, as_of, order_by), rejected_transactions(typed, as_of))


def reject_histogram(rejected: DataFrame) -> DataFrame:
    """C11: rows per combined reason, most frequent first."""
    return (
        rejected.groupBy(REJECT_REASON)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), REJECT_REASON)
    )


# --------------------------------------------------------------------------- customers
def normalise_country(c: Column) -> Column:
    """Title case of a trimmed name, then alias to the full name."""
    titled = title_case(c)
    return F.coalesce(lookup(titled, COUNTRY_ALIASES), titled)


def type_customers(raw: DataFrame) -> DataFrame:
    """Trimmed and normalised customer columns; absent columns stay absent."""
    text = trim_text(raw)
    steps = {
        "Country": lambda: normalise_country(F.col("Country")),
        "SignupDate": lambda: _typed_timestamp(text, "SignupDate"),
        "Segment": lambda: lower_strip(F.col("Segment")),
        "IsActive": lambda: flag(F.col("IsActive")),
    }
    return text.withColumns({c: step() for c, step in steps.items() if c in text.columns})


def clean_customers(raw: DataFrame, order_by: Sequence[str | Column] | None = None) -> Split:
    """Rows without an id are quarantined (C22), the first row of every id is kept."""
    typed = type_customers(raw)
    clean = keep_first(typed.where(F.col("CustomerID").isNotNull()), CUSTOMER_KEY, order_by)
    return Split(clean.drop(ROW_ID), typed.where(F.col("CustomerID").isNull()).drop(ROW_ID))


# --------------------------------------------------------------------------- counters
def cleaning_counters(accepted: DataFrame, keys: Sequence[str], is_rejected: Column) -> DataFrame:
    """Raw, clean, rejected and duplicate rows of a tagged or typed source in one pass.

    Rows are pre-aggregated by key, so copies of one key collapse before the shuffle.
    """
    per_key = accepted.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(is_rejected).alias("_rejected")
    )
    good = F.col("_rows") - F.col("_rejected")
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("raw_rows"),
        F.count_if(good > 0).alias("clean_rows"),
        F.coalesce(F.sum("_rejected"), F.lit(0)).alias("rejected_rows"),
        F.coalesce(F.sum(F.greatest(good - 1, F.lit(0))), F.lit(0)).alias("duplicate_rows"),
    )


def transaction_counters(typed: DataFrame, as_of) -> DataFrame:
    return cleaning_counters(typed, TRANSACTION_KEY, ~F.coalesce(is_accepted(as_of), F.lit(False)))


def customer_counters(typed: DataFrame) -> DataFrame:
    return cleaning_counters(typed, CUSTOMER_KEY, F.col("CustomerID").isNull())
