"""Staging views (G1-G6) and the ad-hoc SQL checks (Q11-Q20).

Money is summed as decimals, so results do not depend on the order of rows.  Sums are kept
wider than a warehouse column would be, as totals of very large tables outgrow 16 digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veritill.functions import as_timestamp, at_scale, capitalise_words, whole_days
from veritill.model import LOADED_AT, VALID_STATUSES
from veritill.operators.quality import sign_mismatch


def _price() -> Column:
    return at_scale(F.col("UnitPrice"), 22, 4)


def _amount() -> Column:
    return at_scale(F.col("Quantity"), 15, 4) * _price()


def _money(c: Column) -> Column:
    return F.round(c, 2).cast("decimal(28,2)")


def _mean(total: Column, n: Column) -> Column:
    return F.round(total / n, 4).cast("decimal(30,4)")


def _plain(c: str, default: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(c), F.lit(default))))


def _loaded(df: DataFrame) -> list[Column]:
    return [F.col(LOADED_AT)] if LOADED_AT in df.columns else []


def customers_view(customers: DataFrame, as_of) -> DataFrame:
    """G1: normalised customers."""
    return customers.where(F.col("CustomerID").isNotNull()).select(
        F.col("CustomerID").alias("customer_id"),
        capitalise_words(F.trim("Country")).alias("country"),
        F.to_date("SignupDate").alias("signup_date"),
        _plain("Segment", "unknown").alias("segment"),
        F.coalesce("IsActive", F.lit(False)).alias("is_active"),
        whole_days(F.col("SignupDate"), as_timestamp(as_of)).cast("int").alias("tenure_days"),
        *_loaded(customers),
    )


def transactions_view(transactions: DataFrame, as_of) -> DataFrame:
    """Typed and enriched transactions."""
    date = F.col("InvoiceDate")
    kept = transactions.where(
        (F.col("UnitPrice") >= 0) & (date <= as_timestamp(as_of)) & F.col("InvoiceNo").isNotNull()
    )
    return kept.select(
        F.col("InvoiceNo").alias("invoice_no"),
        F.col("StockCode").alias("stock_code"),
        capitalise_words(F.trim("Description")).alias("description"),
        F.bround("Quantity", 0).cast("int").alias("quantity"),
        date.alias("invoice_date"),
        _price().alias("unit_price"),
        F.round(_amount(), 4).cast("decimal(34,4)").alias("line_total"),
        F.coalesce("CustomerID", F.lit("GUEST")).alias("customer_id"),
        capitalise_words(F.trim("Country")).alias("country"),
        _plain("Status", "unknown").alias("status"),
        _plain("PaymentMethod", "unknown").alias("payment_method"),
        F.date_trunc("day", date).alias("invoice_day"),
        F.date_trunc("week", date).alias("invoice_week"),
        F.date_trunc("month", date).alias("invoice_month"),
        (F.dayofweek(date) - 1).alias("day_of_week"),
        F.hour(date).alias("hour_of_day"),
        *_loaded(transactions),
    )


def daily_summary(transactions: DataFrame) -> DataFrame:
    """Volume, revenue and cancellation rate per day.

    Rows are summed up per day and customer first, and invoices counted from their distinct pairs, so
    no row is copied for a second distinct count.
    """
    day = F.date_trunc("day", F.col("InvoiceDate"))
    per_customer = transactions.groupBy(day.alias("tx_date"), "CustomerID").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_amount()).alias("amount"),
        F.sum(_price()).alias("price"),
        F.count("UnitPrice").alias("prices"),
        F.count_if(F.col("Status") == "cancelled").alias("cancelled"),
        F.count_if(F.col("Status") == "refunded").alias("refunded"),
    )
    sums = ("n", "amount", "price", "prices", "cancelled", "refunded")
    days = per_customer.groupBy("tx_date").agg(
        *[F.sum(c).alias(c) for c in sums], F.count("CustomerID").alias("unique_customers")
    )
    invoices = transactions.select(day.alias("_day"), "InvoiceNo").distinct().groupBy("_day").agg(
        F.count("InvoiceNo").alias("unique_invoices")
    )
    n, cancelled = F.col("n").cast("decimal(20,0)"), F.col("cancelled").cast("decimal(20,0)")
    return (
        days.join(invoices, F.col("tx_date").eqNullSafe(F.col("_day")))
        .select(
            "tx_date",
            F.col("n").alias("tx_count"),
            "unique_customers",
            "unique_invoices",
            _money(F.col("amount")).alias("gross_revenue"),
            _mean(F.col("price"), F.nullif(F.col("prices"), F.lit(0))).alias("avg_unit_price"),
            F.col("cancelled").alias("cancelled_count"),
            F.col("refunded").alias("refunded_count"),
            F.round(F.lit(100).cast("decimal(5,1)") * cancelled / n, 2).alias("cancellation_rate_pct"),
        )
        .orderBy("tx_date")
    )


def customer_segments(customers: DataFrame) -> DataFrame:
    """Customers per segment, with their share; the window runs over the segments."""
    signup = F.to_date("SignupDate")
    grouped = (
        customers.where(F.col("CustomerID").isNotNull())
        .groupBy(_plain("Segment", "unknown").alias("segment"))
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.count_if(F.col("IsActive")).alias("active_count"),
            F.min(signup).alias("earliest_signup"),
            F.max(signup).alias("latest_signup"),
        )
    )
    n = F.col("customer_count").cast("decimal(20,0)")
    share = F.lit(100).cast("decimal(5,1)") * n / F.sum(n).over(Window.partitionBy())
    return grouped.select(
        "segment",
        "customer_count",
        F.round(share, 2).alias("pct_of_total"),
        "active_count",
        "earliest_signup",
        "latest_signup",
    ).orderBy(F.desc("customer_count"), "segment")


def country_revenue(transactions: DataFrame) -> DataFrame:
    """Revenue per country and its rank; the window runs over the countries."""
    grouped = (
        transactions.where(F.col("UnitPrice") >= 0)
        .groupBy(capitalise_words(F.trim("Country")).alias("country"))
        .agg(
            F.count(F.lit(1)).alias("tx_count"),
            F.countDistinct("CustomerID").alias("unique_customers"),
            F.sum(_amount()).alias("_revenue"),
            F.count(_amount()).alias("_orders"),
        )
    )
    return grouped.select(
        "country",
        "tx_count",
        "unique_customers",
        _money(F.col("_revenue")).alias("total_revenue"),
        _mean(F.col("_revenue"), F.nullif(F.col("_orders"), F.lit(0))).alias("avg_order_value"),
        F.rank().over(Window.orderBy(F.desc_nulls_first("_revenue"))).alias("revenue_rank"),
    ).orderBy(F.desc("total_revenue"), "country")


def freshness(tables: dict[str, DataFrame]) -> DataFrame:
    """Newest load time and rows per table."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.max(LOADED_AT).alias("last_loaded_at"),
            F.count(F.lit(1)).alias("row_count"),
        )
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# --------------------------------------------------------------------------- ad-hoc SQL checks
def sql_duplicate_customers(customers: DataFrame) -> DataFrame:
    """Q11: rows minus distinct ids; every null id counts as a duplicate.

    The distinct count is a second grouping over pre-aggregated ids.
    """
    per_id = customers.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("_n"))
    distinct = F.count("CustomerID")
    return per_id.agg((F.coalesce(F.sum("_n"), F.lit(0)) - distinct).alias("duplicates"))


def sql_duplicate_pairs(transactions: DataFrame) -> DataFrame:
    """Q12: as Q11 for (InvoiceNo, StockCode); a null in either part counts as a duplicate."""
    per_pair = transactions.groupBy("InvoiceNo", "StockCode").agg(F.count(F.lit(1)).alias("_n"))
    whole = F.col("InvoiceNo").isNotNull() & F.col("StockCode").isNotNull()
    return per_pair.agg((F.coalesce(F.sum("_n"), F.lit(0)) - F.count_if(whole)).alias("duplicates"))


def sql_null_rates(transactions: DataFrame) -> DataFrame:
    """Q13: null rates of four columns, null for an empty table."""
    n = F.nullif(F.count(F.lit(1)), F.lit(0)).cast("decimal(20,0)")

    def share(c: str) -> Column:
        return F.round(F.count_if(F.col(c).isNull()).cast("decimal(20,0)") / n, 4).alias(f"null_rate_{c}")

    return transactions.agg(*[share(c) for c in ("InvoiceNo", "InvoiceDate", "UnitPrice", "CustomerID")])


def sql_negative_prices(transactions: DataFrame) -> DataFrame:
    """Q14."""
    return transactions.where(F.col("UnitPrice") < 0).agg(F.count(F.lit(1)).alias("count_negative_price"))


def sql_future_dates(transactions: DataFrame, as_of) -> DataFrame:
    """Q15."""
    future = transactions.where(F.col("InvoiceDate") > as_timestamp(as_of))
    return future.agg(F.count(F.lit(1)).alias("count_future"))


def sql_unexpected_status(transactions: DataFrame) -> DataFrame:
    """Q16: rows per status outside the valid list; null is not counted here."""
    return (
        transactions.where(~F.col("Status").isin(*VALID_STATUSES))
        .groupBy("Status")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), "Status")
    )


def sql_sign_mismatches(fact: DataFrame) -> DataFrame:
    """Q17."""
    return fact.where(sign_mismatch()).agg(F.count(F.lit(1)).alias("mismatches"))


def sql_daily_volume(fact: DataFrame) -> DataFrame:
    """Q18: rows, revenue and mean price per day."""
    return (
        fact.groupBy(F.to_date("InvoiceDate").alias("tx_date"))
        .agg(
            F.count(F.lit(1)).alias("tx_count"),
            F.sum(at_scale(F.col("LineTotal"), 28, 4)).alias("daily_revenue"),
            _mean(F.sum(_price()), F.nullif(F.count("UnitPrice"), F.lit(0))).alias("avg_unit_price"),
        )
        .orderBy("tx_date")
    )


def sql_row_counts(transactions: DataFrame, fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Q19."""
    tables = {"stg_transactions": transactions, "fct_transactions": fact, "stg_customers": customers}
    parts = [
        df.agg(F.lit(f"row count: {name}").alias("source"), F.count(F.lit(1)).alias("rows"))
        for name, df in tables.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def sql_latest_run_summary(history: DataFrame) -> DataFrame:
    """Q20: checks of the newest run by status and severity."""
    newest = history.select(F.max("run_date")).scalar()
    return (
        history.where(F.col("run_date") == newest)
        .groupBy("run_date", "status", "severity")
        .agg(F.count(F.lit(1)).alias("check_count"))
        .orderBy("status", "severity")
    )
