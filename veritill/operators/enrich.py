"""Joins and enrichment: from clean rows to the fact table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritill.functions import lookup, strip, tenure_days
from veritill.model import COUNTRY_ISO2, FCT_TRANSACTIONS
from veritill.operators.skew import left_lookup

_CUSTOMER_COLUMNS = {
    "Country": "Customer_Country",
    "SignupDate": "SignupDate",
    "Segment": "CustomerSegment",
    "IsActive": "CustomerIsActive",
}


def customer_dimension(customers: DataFrame) -> DataFrame:
    """The joined columns of clean customers under their fact names, plus a match marker."""
    columns = [strip(F.col("CustomerID").cast("string")).alias("CustomerID")]
    for source, target in _CUSTOMER_COLUMNS.items():
        given = next((c for c in (source, target) if c in customers.columns), None)
        dtype = FCT_TRANSACTIONS[target].dataType
        value = F.col(given) if given else F.lit(None)
        columns.append(value.cast(dtype).alias(target))
    return customers.where(F.col("CustomerID").isNotNull()).select(*columns, F.lit(True).alias("_matched"))


def join_customers(
    transactions: DataFrame,
    customers: DataFrame,
    strict_reference: bool = False,
    salted: bool = False,
) -> DataFrame:
    """Every transaction with its customer's columns and ``is_known_customer``.

    A customer is known when its id exists; with ``strict_reference`` a matched customer
    without a segment counts as unknown.
    """
    keyed = transactions.withColumn("CustomerID", strip(F.col("CustomerID").cast("string")))
    joined = left_lookup(keyed, customer_dimension(customers), ["CustomerID"], salted=salted)
    known = F.col("CustomerSegment").isNotNull() if strict_reference else F.col("_matched").isNotNull()
    order = [*transactions.columns, *_CUSTOMER_COLUMNS.values()]
    return joined.select(*order, known.alias("is_known_customer"))


def holiday_lookup(holidays: DataFrame) -> DataFrame:
    """One holiday name per country and day, so the join never multiplies rows."""
    return (
        holidays.where(F.col("country_code").isNotNull() & F.col("date").isNotNull())
        .groupBy(F.col("country_code").alias("_iso2"), F.to_date("date").alias("_day"))
        .agg(F.min("name").alias("holiday_name"))
    )


def enrich_holidays(
    df: DataFrame,
    holidays: DataFrame | None,
    iso2: Mapping[str, str] = COUNTRY_ISO2,
) -> DataFrame:
    """``is_holiday`` and ``holiday_name`` by invoice day and transaction country.

    Only days of the mapped countries can match, one row each, so the calendar is broadcast and no transaction
    is shuffled for it.
    """
    if holidays is None:
        return df.withColumns({"is_holiday": F.lit(False), "holiday_name": F.lit(None).cast("string")})
    country = lookup(F.col("Country"), iso2) if "Country" in df.columns else F.lit(None).cast("string")
    keyed = df.withColumns({"_iso2": country, "_day": F.to_date("InvoiceDate")})
    days = holiday_lookup(holidays.where(F.col("country_code").isin(*set(iso2.values()))))
    matched = keyed.join(F.broadcast(days), ["_iso2", "_day"], "left")
    return matched.select(*df.columns, F.col("holiday_name").isNotNull().alias("is_holiday"), "holiday_name")


def derive_columns(df: DataFrame, iso2: Mapping[str, str] = COUNTRY_ISO2) -> DataFrame:
    """Tenure, ISO week and country code, each where its inputs exist."""
    if {"SignupDate", "InvoiceDate"} <= set(df.columns):
        signup, invoice = F.col("SignupDate").cast("timestamp"), F.col("InvoiceDate").cast("timestamp")
        df = df.withColumn("customer_tenure_days", tenure_days(signup, invoice))
    if "InvoiceDate" in df.columns:
        df = df.withColumn("TxWeek", F.weekofyear("InvoiceDate"))
    if "Country" in df.columns:
        df = df.withColumn("CountryISO2", lookup(F.col("Country"), iso2))
    return df


def build_fact(
    transactions: DataFrame,
    customers: DataFrame,
    holidays: DataFrame | None = None,
    iso2: Mapping[str, str] = COUNTRY_ISO2,
    strict_reference: bool = False,
    salted: bool = False,
) -> DataFrame:
    """The 25-column fact table; it has exactly the rows of ``transactions``.

    ``salted`` concerns the customer join; pass stored ``transactions`` with it.
    """
    return finish_fact(join_customers(transactions, customers, strict_reference, salted), holidays, iso2)


def finish_fact(joined: DataFrame, holidays: DataFrame | None = None, iso2: Mapping[str, str] = COUNTRY_ISO2) -> DataFrame:
    """The second half of ``build_fact``, which shuffles nothing: ``save_fact`` does it after its shuffle."""
    return derive_columns(enrich_holidays(joined, holidays, iso2), iso2)


def orphan_rate(fact: DataFrame) -> DataFrame:
    """Rows without a known customer, and their share in percent."""
    unknown = F.count_if(~F.col("is_known_customer"))
    n = F.count(F.lit(1))
    return fact.agg(
        n.alias("tx_rows"),
        unknown.alias("orphan_rows"),
        (F.lit(100.0) * unknown / F.greatest(n, F.lit(1))).alias("orphan_pct"),
    )


def orphan_countries(fact: DataFrame, top: int = 10) -> DataFrame:
    """Countries with the most unknown-customer rows."""
    return (
        fact.where(~F.col("is_known_customer") & F.col("Country").isNotNull())
        .groupBy("Country")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), "Country")
        .limit(top)
    )


def orphans_by_key(facts: DataFrame, customers: DataFrame, key: str = "CustomerID", customer_key: str = "CustomerID") -> DataFrame:
    """Ids without a customer and the rows they hold; null ids are guests, not orphans.

    Rows are counted per id before the anti join, so a hot id reaches it as one row.
    """
    per_id = (
        facts.where(F.col(key).isNotNull())
        .groupBy(F.col(key).cast("string").alias("CustomerID"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = customers.where(F.col(customer_key).isNotNull()).select(
        F.col(customer_key).cast("string").alias("CustomerID")
    )
    return per_id.join(known, "CustomerID", "left_anti")


def orphan_count(facts: DataFrame, customers: DataFrame, key: str = "CustomerID", customer_key: str = "CustomerID") -> DataFrame:
    """One row with the number of orphan rows."""
    orphans = orphans_by_key(facts, customers, key, customer_key)
    return orphans.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_count"))
