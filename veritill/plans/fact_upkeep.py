"""Upkeep of the fact table (J12): a late file rewrites the months it touches and no others.

The fact lies in the warehouse as one part per month.  ``refresh`` compares the new customers and
holidays with those the fact was built from, finds the months with transactions of changed customers or
on changed days (a scan of three columns), builds these months anew from their own transaction columns,
and publishes them together with the new customers and holidays as one version.  Unchanged months keep
their files.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritill.functions import lookup, strip
from veritill.model import COUNTRY_ISO2
from veritill.operators.enrich import customer_dimension, finish_fact, holiday_lookup, join_customers
from veritill.session import scratch_dir
from veritill.sources import sinks, snapshots

FACT, CUSTOMERS, HOLIDAYS = "fct_months", "dim_customers", "dim_calendar"
#: Where transactions without a date would go; cleaning leaves none.
_NO_MONTH = "none"


class Refreshed(NamedTuple):
    #: Keys of the months that were written, and rows in them.
    months: list[str]
    rows: int


def month_key() -> Column:
    key = F.format_string("%04d-%02d", F.col("TxYear"), F.col("TxMonth"))
    return F.when(F.col("TxYear").isNotNull() & F.col("TxMonth").isNotNull(), key).otherwise(F.lit(_NO_MONTH))


def _gathered(rows: DataFrame) -> DataFrame:
    """The rows of a month together, so that a task does not leave a small file in every month."""
    return rows.hint("rebalance", "TxYear", "TxMonth")


def _stage_months(fact: DataFrame, warehouse: str) -> list[snapshots.Part]:
    """Write rows, gathered by month, into one folder per month, each a part of its own."""
    spark, path = fact.sparkSession, snapshots.new_part(warehouse, FACT)
    keyed = fact.withColumn("month_key", month_key())
    sinks._write(keyed, path, "errorifexists", ("month_key",))
    try:
        # row counts come from the files' footers; one row per month
        counts = spark.read.parquet(path).groupBy(F.col("month_key").cast("string")).count().collect()
    except Exception:
        if fact.isEmpty():
            return []
        raise
    name, schema = path.rsplit("/", 1)[1], fact.schema.json()
    return [snapshots.Part(f"{name}/month_key={row[0]}", row[1], schema, row[0]) for row in sorted(counts)]


def _whole(df: DataFrame, warehouse: str, table: str) -> snapshots.Change:
    return snapshots.Change("replace", (sinks._stage(df, warehouse, table),))


def create(
    transactions: DataFrame, customers: DataFrame, holidays: DataFrame, warehouse: str, published_at: str | datetime,
    iso2: Mapping[str, str] = COUNTRY_ISO2, slices: int = 1,
) -> Refreshed:
    """Build the whole fact and keep it with what it was built from.

    Several ``slices`` of the months are built one after the other, as ``sinks.save_fact`` does; pass stored tables then.
    """
    parts: list[snapshots.Part] = []
    for n in range(slices):
        own = transactions if slices == 1 else transactions.where(sinks.month_slice(slices) == n)
        parts += _stage_months(finish_fact(_gathered(join_customers(own, customers)), holidays, iso2), warehouse)
    parts.sort(key=lambda part: part.key)
    changes = {
        FACT: snapshots.Change("replace", tuple(parts)),
        CUSTOMERS: _whole(customer_dimension(customers), warehouse, CUSTOMERS),
        HOLIDAYS: _whole(holiday_lookup(holidays), warehouse, HOLIDAYS),
    }
    snapshots.publish(transactions.sparkSession, warehouse, changes, published_at)
    return Refreshed([part.key for part in parts], sum(part.rows for part in parts))


def changed_keys(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose row is new, gone or different; both sides have one row per key."""
    values = [c for c in after.columns if c not in keys]
    old = before.select(*keys, F.struct(*values).alias("old"))
    new = after.select(*keys, F.struct(*values).alias("new"))
    return old.join(new, keys, "full").where(~F.col("old").eqNullSafe(F.col("new"))).select(*keys)


def touched_months(fact: DataFrame, customers: DataFrame, days: DataFrame, iso2: Mapping[str, str] = COUNTRY_ISO2) -> list[str]:
    """Months with a transaction of one of the customers, or in the country and on the day of one of ``days``."""
    of = fact.select(month_key().alias("month_key"), "CustomerID", lookup(F.col("Country"), iso2).alias("_iso2"), F.to_date("InvoiceDate").alias("_day"))
    # one row per month, customer and day before any join, so hot customers do not meet in one task
    by_customer = of.select("month_key", "CustomerID").distinct().join(customers, "CustomerID", "left_semi")
    by_day = of.select("month_key", "_iso2", "_day").distinct().join(days, ["_iso2", "_day"], "left_semi")
    months = by_customer.select("month_key").union(by_day.select("month_key")).distinct()
    return sorted(row[0] for row in months.collect())


def refresh(
    spark: SparkSession, warehouse: str, published_at: str | datetime, customers: DataFrame | None = None,
    holidays: DataFrame | None = None, iso2: Mapping[str, str] = COUNTRY_ISO2,
) -> Refreshed:
    """Bring the fact up to new customers, new holidays or both; equal to building all of it anew."""
    while True:
        try:
            return _refresh(spark, warehouse, published_at, customers, holidays, iso2)
        except snapshots.Conflict:
            continue  # another load was published meanwhile: compare with that one


def _refresh(spark, warehouse, published_at, customers, holidays, iso2) -> Refreshed:
    version = snapshots.current(spark, warehouse)
    read = lambda table: snapshots.read(spark, warehouse, table, version.number)
    folder = scratch_dir(spark, "dimensions")
    sides = {}
    for table, made, keys in (
        (CUSTOMERS, None if customers is None else customer_dimension(customers), ["CustomerID"]),
        (HOLIDAYS, None if holidays is None else holiday_lookup(holidays), ["_iso2", "_day"]),
    ):
        before = read(table)
        if made is None:
            sides[table] = (before, before.select(*keys).where("false"))
            continue
        made.write.parquet(f"{folder}/{table}")
        after = spark.read.schema(made.schema).parquet(f"{folder}/{table}")
        sides[table] = (after, changed_keys(before, after, keys))
    fact = read(FACT)
    keyed = fact.withColumn("CustomerID", strip(F.col("CustomerID").cast("string")))
    months = touched_months(keyed, sides[CUSTOMERS][1], sides[HOLIDAYS][1], iso2)

    parts: list[snapshots.Part] = []
    if months:
        held = {part.key: f"{warehouse}/{FACT}/{part.path}" for part in version.tables[FACT]}
        changed = sides[CUSTOMERS][0] if customers is not None else None
        # some months at a time: the shuffle files of the others are not on the executors' disks meanwhile
        for n in range(min(sinks.FACT_SLICES, len(months))):
            own = spark.read.schema(fact.schema).parquet(*[held[month] for month in months[n :: sinks.FACT_SLICES]])
            parts += _stage_months(_rebuilt(own, changed, sides[HOLIDAYS][0], iso2), warehouse)
        parts.sort(key=lambda part: part.key)
    changes = {FACT: snapshots.Change("replace_key", tuple(parts))}
    for table, given in ((CUSTOMERS, customers), (HOLIDAYS, holidays)):
        if given is not None:
            changes[table] = _whole(sides[table][0], warehouse, table)
    snapshots.publish(spark, warehouse, changes, published_at, based_on=version)
    return Refreshed(months, sum(part.rows for part in parts))


def _rebuilt(fact: DataFrame, dimension: DataFrame | None, days: DataFrame, iso2: Mapping[str, str]) -> DataFrame:
    """The same transactions with the columns that the other tables give them made anew.

    Without a new ``dimension`` the customer columns stay as they are, and so do the rows: files of a month are
    read and written without a shuffle.
    """
    made = {"is_holiday", "holiday_name", "customer_tenure_days", "TxWeek", "CountryISO2"}
    calendar = days.select(F.col("_iso2").alias("country_code"), F.col("_day").alias("date"), F.col("holiday_name").alias("name"))
    if dimension is None:
        own = fact.select(*[c for c in fact.columns if c not in made])
    else:
        plain = dimension.drop("_matched")
        given = {*plain.columns, "is_known_customer"} - {"CustomerID"}
        own = _gathered(join_customers(fact.select(*[c for c in fact.columns if c not in made | given]), plain))
    return finish_fact(own, calendar, iso2).select(*fact.columns)


def read_fact(spark: SparkSession, warehouse: str, version: int | None = None) -> DataFrame:
    return snapshots.read(spark, warehouse, FACT, version)
