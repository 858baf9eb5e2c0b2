"""Queries over the joins and enrichment operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritill.catalogue import adapters, frames
from veritill.catalogue.adapters import plain
from veritill.catalogue.oracle import FACT_COLUMNS, JOINED_COLUMNS, iso2, with_ctes
from veritill.catalogue.registry import query
from veritill.functions import lookup
from veritill.model import COUNTRY_ISO2
from veritill.operators import enrich

_ORPHANS = """FROM typed_tx t WHERE "CustomerID" IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM clean_cu c WHERE c."CustomerID" = t."CustomerID")"""


@query(
    "j01_join",
    with_ctes(f'SELECT "InvoiceNo", "StockCode", "CustomerID", {JOINED_COLUMNS} FROM fact', "fact"),
)
def j01(spark, sf):
    joined = enrich.join_customers(frames.clean_tx(spark, sf), frames.clean_cu(spark, sf))
    return plain(
        joined.select(
            "InvoiceNo", "StockCode", "CustomerID", "Customer_Country", "SignupDate",
            "CustomerSegment", "CustomerIsActive", "is_known_customer",
        )
    )


@query(
    "j01_join_salted",
    with_ctes(f'SELECT "InvoiceNo", "StockCode", "CustomerID", {JOINED_COLUMNS} FROM fact', "fact"),
)
def j01_salted(spark, sf):
    """The same join on its way for large dimensions: hot and null keys spread over buckets."""
    tx = frames.stored(frames.clean_tx(spark, sf), "transactions")
    joined = enrich.join_customers(tx, frames.clean_cu(spark, sf), salted=True)
    return plain(
        joined.select(
            "InvoiceNo", "StockCode", "CustomerID", "Customer_Country", "SignupDate",
            "CustomerSegment", "CustomerIsActive", "is_known_customer",
        )
    )


@query(
    "j02_known_flag",
    with_ctes(
        """SELECT CAST(is_known_customer AS VARCHAR) AS is_known_customer,
             CAST("CustomerSegment" IS NOT NULL AS VARCHAR) AS has_segment, COUNT(*) AS row_count
           FROM fact GROUP BY ALL""",
        "fact",
    ),
)
def j02(spark, sf):
    tx, cu = frames.clean_tx(spark, sf), frames.clean_cu(spark, sf)
    joined = enrich.join_customers(tx, cu)
    flags = joined.select("is_known_customer", F.col("CustomerSegment").isNotNull().alias("has_segment"))
    return plain(flags.groupBy("is_known_customer", "has_segment").agg(F.count(F.lit(1)).alias("row_count")))


@query(
    "j03_orphan_rate",
    with_ctes(
        """SELECT COUNT(*) AS tx_rows, COUNT(*) FILTER (WHERE NOT is_known_customer) AS orphan_rows,
             100.0::DOUBLE * COUNT(*) FILTER (WHERE NOT is_known_customer) / greatest(COUNT(*), 1) AS orphan_pct
           FROM fact""",
        "fact",
    ),
)
def j03(spark, sf):
    return enrich.orphan_rate(frames.fact(spark, sf))


@query(
    "j04_orphan_countries",
    with_ctes(
        """SELECT "Country", COUNT(*) AS row_count FROM fact WHERE NOT is_known_customer
           GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "fact",
    ),
)
def j04(spark, sf):
    return enrich.orphan_countries(frames.fact(spark, sf))


@query(
    "j05_holiday_join",
    with_ctes(
        """SELECT "InvoiceNo", "StockCode", "Country", CAST(is_holiday AS VARCHAR) AS is_holiday, holiday_name
           FROM fact""",
        "fact",
    ),
)
def j05(spark, sf):
    flagged = enrich.enrich_holidays(frames.clean_tx(spark, sf), adapters.holidays(spark, sf))
    return plain(flagged.select("InvoiceNo", "StockCode", "Country", "is_holiday", "holiday_name"))


@query("j07_orphans_anti", with_ctes(f"SELECT COUNT(*) AS orphan_count {_ORPHANS}", "typed_tx", "clean_cu"))
def j07(spark, sf):
    return enrich.orphan_count(frames.typed_tx(spark, sf), frames.clean_cu(spark, sf))


@query(
    "j08_not_exists",
    with_ctes(f'SELECT "CustomerID", COUNT(*) AS row_count {_ORPHANS} GROUP BY 1', "typed_tx", "clean_cu"),
)
def j08(spark, sf):
    return enrich.orphans_by_key(frames.typed_tx(spark, sf), frames.clean_cu(spark, sf))


@query(
    "j09_tenure",
    with_ctes("SELECT customer_tenure_days, COUNT(*) AS row_count FROM fact GROUP BY 1", "fact"),
)
def j09(spark, sf):
    fact = frames.fact(spark, sf)
    return fact.groupBy("customer_tenure_days").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "j10_iso_week",
    """SELECT CAST(weekofyear(o_orderdate) AS INTEGER) AS "TxWeek", strftime(o_orderdate, '%Y-%m-%d') AS day,
         COUNT(*) AS row_count FROM orders GROUP BY ALL""",
)
def j10(spark, sf):
    orders = adapters.table(spark, sf, "orders").select(F.col("o_orderdate").alias("InvoiceDate"))
    weeks = enrich.derive_columns(orders).groupBy("TxWeek", F.to_date("InvoiceDate").alias("day"))
    return plain(weeks.agg(F.count(F.lit(1)).alias("row_count")))


@query(
    "j11_iso2",
    with_ctes(
        f"""SELECT "Country", {iso2('"Country"')} AS "CountryISO2", COUNT(*) AS row_count
            FROM typed_tx GROUP BY ALL""",
        "typed_tx",
    ),
)
def j11(spark, sf):
    coded = frames.typed_tx(spark, sf).select("Country", lookup(F.col("Country"), COUNTRY_ISO2).alias("CountryISO2"))
    return coded.groupBy("Country", "CountryISO2").agg(F.count(F.lit(1)).alias("row_count"))


@query("j12_fact", with_ctes(f"SELECT {FACT_COLUMNS} FROM fact", "fact"))
def j12(spark, sf):
    return plain(frames.fact(spark, sf))
