"""Queries over the staging views."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritill.catalogue import frames
from veritill.catalogue.adapters import AS_OF, plain
from veritill.catalogue.oracle import NOW, day_text, exact_ratio, ts_text, with_ctes, words
from veritill.catalogue.registry import query
from veritill.operators import views
from veritill.model import LOADED_AT
from veritill.functions import as_timestamp

_PRICE = 'CAST("UnitPrice" AS DECIMAL(12, 4))'
_AMOUNT = f'CAST("Quantity" AS DECIMAL(14, 4)) * {_PRICE}'
DAILY = f"""SELECT {ts_text("date_trunc('day', " + '"InvoiceDate")')} AS tx_date, COUNT(*) AS tx_count,
    COUNT(DISTINCT "CustomerID") AS unique_customers, COUNT(DISTINCT "InvoiceNo") AS unique_invoices,
    CAST(CAST(SUM({_AMOUNT}) AS DECIMAL(28, 2)) AS DOUBLE) AS gross_revenue,
    {exact_ratio(f"SUM({_PRICE})", 'COUNT("UnitPrice")', 4, 4)} AS avg_unit_price,
    COUNT(*) FILTER (WHERE "Status" = 'cancelled') AS cancelled_count,
    COUNT(*) FILTER (WHERE "Status" = 'refunded') AS refunded_count,
    {exact_ratio("""100 * COUNT(*) FILTER (WHERE "Status" = 'cancelled')""", "COUNT(*)", 0, 2)} AS cancellation_rate_pct
  FROM clean_tx GROUP BY 1 ORDER BY 1"""


def _plain_text(column: str) -> str:
    return f"lower(trim(COALESCE({column}, 'unknown')))"


@query(
    "g01_customers_v",
    with_ctes(
        f"""SELECT "CustomerID" AS customer_id, {words('trim("Country")')} AS country,
              {day_text('"SignupDate"')} AS signup_date, {_plain_text('"Segment"')} AS segment,
              CAST(COALESCE("IsActive", FALSE) AS VARCHAR) AS is_active,
              CAST(date_sub('day', "SignupDate", {NOW}) AS INTEGER) AS tenure_days
            FROM clean_cu""",
        "clean_cu",
    ),
)
def g01(spark, sf):
    return plain(views.customers_view(frames.clean_cu(spark, sf), AS_OF))


@query(
    "g02_transactions_v",
    with_ctes(
        f"""SELECT "InvoiceNo" AS invoice_no, "StockCode" AS stock_code, {words('trim("Description")')} AS description,
              CAST("Quantity" AS INTEGER) AS quantity, {ts_text('"InvoiceDate"')} AS invoice_date,
              CAST({_PRICE} AS DOUBLE) AS unit_price, CAST({_AMOUNT} AS DOUBLE) AS line_total,
              COALESCE("CustomerID", 'GUEST') AS customer_id, {words('trim("Country")')} AS country,
              {_plain_text('"Status"')} AS status, {_plain_text('"PaymentMethod"')} AS payment_method,
              {ts_text("date_trunc('day', " + '"InvoiceDate")')} AS invoice_day,
              {ts_text("date_trunc('week', " + '"InvoiceDate")')} AS invoice_week,
              {ts_text("date_trunc('month', " + '"InvoiceDate")')} AS invoice_month,
              CAST(dayofweek("InvoiceDate") AS INTEGER) AS day_of_week,
              CAST(hour("InvoiceDate") AS INTEGER) AS hour_of_day
            FROM typed_tx WHERE "UnitPrice" >= 0 AND "InvoiceDate" <= {NOW} AND "InvoiceNo" IS NOT NULL""",
        "typed_tx",
    ),
)
def g02(spark, sf):
    """Over typed rows, so that the view's own filter has something to drop."""
    return plain(views.transactions_view(frames.typed_tx(spark, sf), AS_OF))


@query("g03_daily_summary", with_ctes(DAILY, "clean_tx"))
def g03(spark, sf):
    return plain(views.daily_summary(frames.clean_tx(spark, sf)))


_LARGE = """(SELECT * REPLACE (CASE WHEN CAST("InvoiceNo" AS BIGINT) % 5 = 0 THEN "UnitPrice" * 1e7
                            ELSE "UnitPrice" END AS "UnitPrice") FROM clean_tx)"""


@query(
    "g03_large_amounts",
    with_ctes(
        DAILY.replace("DECIMAL(12, 4)", "DECIMAL(22, 4)").replace("DECIMAL(14, 4)", "DECIMAL(15, 4)")
        .replace("FROM clean_tx", f"FROM {_LARGE}"),
        "clean_tx",
    ),
)
def g03_large(spark, sf):
    """Prices far beyond a warehouse column; none drops out of sums and means."""
    price = F.when(F.col("InvoiceNo").cast("bigint") % 5 == 0, F.col("UnitPrice") * 1e7).otherwise(F.col("UnitPrice"))
    return plain(views.daily_summary(frames.clean_tx(spark, sf).withColumn("UnitPrice", price)))


@query(
    "g04_segments",
    with_ctes(
        f"""SELECT {_plain_text('"Segment"')} AS segment, COUNT(*) AS customer_count,
              {exact_ratio("100 * COUNT(*)", "SUM(COUNT(*)) OVER ()", 0, 2)} AS pct_of_total,
              COUNT(*) FILTER (WHERE "IsActive") AS active_count,
              {day_text('MIN("SignupDate")')} AS earliest_signup, {day_text('MAX("SignupDate")')} AS latest_signup
            FROM clean_cu GROUP BY 1 ORDER BY 2 DESC, 1""",
        "clean_cu",
    ),
)
def g04(spark, sf):
    return plain(views.customer_segments(frames.clean_cu(spark, sf)))


@query(
    "g05_country_revenue",
    with_ctes(
        f"""SELECT {words('trim("Country")')} AS country, COUNT(*) AS tx_count,
              COUNT(DISTINCT "CustomerID") AS unique_customers,
              CAST(CAST(SUM({_AMOUNT}) AS DECIMAL(28, 2)) AS DOUBLE) AS total_revenue,
              {exact_ratio(f"SUM({_AMOUNT})", f"COUNT({_AMOUNT})", 8, 4)} AS avg_order_value,
              CAST(RANK() OVER (ORDER BY SUM({_AMOUNT}) DESC) AS INTEGER) AS revenue_rank
            FROM clean_tx WHERE "UnitPrice" >= 0 GROUP BY 1 ORDER BY 4 DESC, 1""",
        "clean_tx",
    ),
)
def g05(spark, sf):
    return plain(views.country_revenue(frames.clean_tx(spark, sf)))


@query(
    "g06_freshness",
    with_ctes(
        f"""SELECT 'stg_customers' AS table_name, '{AS_OF}' AS last_loaded_at, COUNT(*) AS row_count FROM clean_cu
            UNION ALL SELECT 'stg_transactions', '{AS_OF}', COUNT(*) FROM clean_tx
            UNION ALL SELECT 'fct_transactions', '{AS_OF}', COUNT(*) FROM fact""",
        "fact",
    ),
)
def g06(spark, sf):
    frames_by_table = {
        "stg_customers": frames.clean_cu(spark, sf),
        "stg_transactions": frames.clean_tx(spark, sf),
        "fct_transactions": frames.fact(spark, sf),
    }
    stamped = {t: df.withColumn(LOADED_AT, as_timestamp(AS_OF)) for t, df in frames_by_table.items()}
    return plain(views.freshness(stamped))
