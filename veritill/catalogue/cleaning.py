"""Queries over the cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritill.catalogue import adapters, frames
from veritill.catalogue.adapters import AS_OF, plain
from veritill.catalogue.oracle import (
    CLEAN_COLUMNS,
    CUSTOMER_COLUMNS,
    country,
    flag,
    parse,
    status,
    title,
    ts_text,
    with_ctes,
)
from veritill.catalogue.registry import query
from veritill.functions import (
    flag as flag_expr,
    lower_strip,
    normalise_status,
    number,
    parse_timestamp,
    title_case,
)
from veritill.operators import cleaning
from veritill.operators.cleaning import normalise_country


def _counted(column: str, source: str, expr: str) -> str:
    return f'SELECT {expr} AS "{column}", COUNT(*) AS row_count FROM {source} GROUP BY 1'


def _histogram(df, column: str, expr=None):
    value = F.col(column) if expr is None else expr
    return df.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "c01_trim",
    with_ctes(
        """SELECT "InvoiceNo", "StockCode", trim("Description") AS "Description", "Quantity", "InvoiceDate",
          "UnitPrice", trim("CustomerID") AS "CustomerID", "Country", trim("Status") AS "Status",
          trim("PaymentMethod") AS "PaymentMethod" FROM raw_tx""",
        "raw_tx",
    ),
)
def c01(spark, sf):
    return cleaning.trim_text(adapters.raw_transactions(spark, sf)).drop("_row_id")


@query(
    "c02_dates",
    with_ctes(f'SELECT {ts_text(parse('"InvoiceDate"'))} AS parsed, COUNT(*) AS row_count FROM raw_tx GROUP BY 1', "raw_tx"),
)
def c02(spark, sf):
    raw = adapters.raw_transactions(spark, sf)
    return plain(_histogram(raw, "parsed", parse_timestamp(F.col("InvoiceDate"))))


@query(
    "c03_numeric",
    with_ctes(
        """SELECT TRY_CAST("Quantity" AS DOUBLE) AS quantity, COUNT(*) AS row_count,
          COUNT(TRY_CAST("UnitPrice" AS DOUBLE)) AS prices,
          MIN(TRY_CAST("UnitPrice" AS DOUBLE)) AS lowest, MAX(TRY_CAST("UnitPrice" AS DOUBLE)) AS highest
          FROM raw_tx GROUP BY 1""",
        "raw_tx",
    ),
)
def c03(spark, sf):
    price = number(F.col("UnitPrice"))
    return (
        adapters.raw_transactions(spark, sf)
        .groupBy(number(F.col("Quantity")).alias("quantity"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count(price).alias("prices"),
            F.min(price).alias("lowest"),
            F.max(price).alias("highest"),
        )
    )


_RULES = ("bad_date", "bad_unit_price", "bad_quantity", "negative_price", "future_date")


@query(
    "c04_reject_rules",
    with_ctes(
        "SELECT "
        + ", ".join(
            f"""COUNT(*) FILTER (WHERE list_contains(string_split("_reject_reason", '|'), '{r}')) AS {r}"""
            for r in _RULES
        )
        + " FROM tagged_tx",
        "tagged_tx",
    ),
)
def c04(spark, sf):
    rules = cleaning.reject_rules(AS_OF)
    return frames.typed_tx(spark, sf).agg(*[F.count_if(bad).alias(label) for label, bad in rules.items()])


@query(
    "c09_reject_reasons",
    with_ctes("""SELECT "InvoiceNo", "StockCode", "_reject_reason" FROM tagged_tx WHERE "_reject_reason" <> '' """, "tagged_tx"),
)
def c09(spark, sf):
    rejected = cleaning.rejected_transactions(frames.typed_tx(spark, sf), AS_OF)
    return rejected.select("InvoiceNo", "StockCode", "_reject_reason")


@query(
    "c10_quarantine",
    with_ctes(
        f"""SELECT "InvoiceNo", "StockCode", "Description", "Quantity", {ts_text('"InvoiceDate"')} AS "InvoiceDate",
          "UnitPrice", "CustomerID", "Country", "Status", "PaymentMethod", "_reject_reason"
          FROM tagged_tx WHERE "_reject_reason" <> '' """,
        "tagged_tx",
    ),
)
def c10(spark, sf):
    return plain(frames.split_tx(spark, sf).rejected)


@query(
    "c11_reason_histogram",
    with_ctes(
        """SELECT "_reject_reason", COUNT(*) AS row_count FROM tagged_tx
           WHERE "_reject_reason" <> '' GROUP BY 1 ORDER BY 2 DESC, 1""",
        "tagged_tx",
    ),
)
def c11(spark, sf):
    return cleaning.reject_histogram(frames.split_tx(spark, sf).rejected)


@query("c12_clean_transactions", with_ctes(f"SELECT {CLEAN_COLUMNS} FROM clean_tx", "clean_tx"))
def c12(spark, sf):
    return plain(frames.clean_tx(spark, sf))


@query("c13_title_case", with_ctes(_counted("titled", "raw_tx", title("trim(\"Description\")")), "raw_tx"))
def c13(spark, sf):
    raw = cleaning.trim_text(adapters.raw_transactions(spark, sf))
    return _histogram(raw, "titled", title_case(F.col("Description")))


@query("c14_status", with_ctes(_counted("Status", "raw_tx", status('"Status"')), "raw_tx"))
def c14(spark, sf):
    return _histogram(adapters.raw_transactions(spark, sf), "Status", normalise_status(F.col("Status")))


@query(
    "c15_dedupe",
    """SELECT CAST(l_orderkey AS VARCHAR) AS "InvoiceNo", CAST(l_linenumber AS INTEGER) AS line,
         MIN(l_partkey) AS "StockCode" FROM lineitem GROUP BY l_orderkey, l_linenumber""",
)
def c15(spark, sf):
    line = adapters.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("InvoiceNo"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("StockCode"),
    )
    return cleaning.keep_first(line, ("InvoiceNo", "line"), ["StockCode"])


@query("c16_line_total", with_ctes('SELECT "InvoiceNo", "StockCode", "LineTotal" FROM clean_tx', "clean_tx"))
def c16(spark, sf):
    return frames.clean_tx(spark, sf).select("InvoiceNo", "StockCode", "LineTotal")


@query(
    "c17_date_parts",
    with_ctes('SELECT "TxYear", "TxMonth", "TxDay", "TxDOW", COUNT(*) AS row_count FROM clean_tx GROUP BY ALL', "clean_tx"),
)
def c17(spark, sf):
    parts = frames.clean_tx(spark, sf).groupBy("TxYear", "TxMonth", "TxDay", "TxDOW")
    return parts.agg(F.count(F.lit(1)).alias("row_count"))


@query("c18_country", with_ctes(_counted("Country", "raw_cu", country('"Country"')), "raw_cu"))
def c18(spark, sf):
    return _histogram(adapters.raw_customers(spark, sf), "Country", normalise_country(F.col("Country")))


@query("c19_signup", with_ctes(_counted("SignupDate", "raw_cu", ts_text(parse('"SignupDate"'))), "raw_cu"))
def c19(spark, sf):
    return plain(_histogram(adapters.raw_customers(spark, sf), "SignupDate", parse_timestamp(F.col("SignupDate"))))


@query("c20_segment", with_ctes(_counted("Segment", "raw_cu", 'trim(lower("Segment"))'), "raw_cu"))
def c20(spark, sf):
    return _histogram(adapters.raw_customers(spark, sf), "Segment", lower_strip(F.col("Segment")))


@query(
    "c21_is_active",
    with_ctes(_counted("IsActive", "raw_cu", f"""CAST({flag('"IsActive"')} AS VARCHAR)"""), "raw_cu"),
)
def c21(spark, sf):
    return plain(_histogram(adapters.raw_customers(spark, sf), "IsActive", flag_expr(F.col("IsActive"))))


@query(
    "c22_missing_id",
    with_ctes(f'SELECT {CUSTOMER_COLUMNS} FROM typed_cu WHERE "CustomerID" IS NULL', "typed_cu"),
)
def c22(spark, sf):
    return plain(frames.split_cu(spark, sf).rejected)


@query("c23_dedupe_customer", with_ctes('SELECT "CustomerID", "Country" FROM clean_cu', "clean_cu"))
def c23(spark, sf):
    return frames.clean_cu(spark, sf).select("CustomerID", "Country")


@query("c24_clean_customers", with_ctes(f"SELECT {CUSTOMER_COLUMNS} FROM clean_cu", "clean_cu"))
def c24(spark, sf):
    return plain(frames.clean_cu(spark, sf))


@query(
    "c25_counters",
    with_ctes(
        """SELECT 'transactions' AS source, COUNT(*) AS raw_rows, (SELECT COUNT(*) FROM clean_tx) AS clean_rows,
             COUNT(*) FILTER (WHERE "_reject_reason" <> '') AS rejected_rows,
             COUNT(*) FILTER (WHERE "_reject_reason" = '') - (SELECT COUNT(*) FROM clean_tx) AS duplicate_rows
           FROM tagged_tx
           UNION ALL
           SELECT 'customers', COUNT(*), (SELECT COUNT(*) FROM clean_cu),
             COUNT(*) FILTER (WHERE "CustomerID" IS NULL),
             COUNT("CustomerID") - (SELECT COUNT(*) FROM clean_cu) FROM typed_cu""",
        "clean_tx",
        "clean_cu",
    ),
)
def c25(spark, sf):
    tx = cleaning.transaction_counters(frames.typed_tx(spark, sf), AS_OF)
    cu = cleaning.customer_counters(cleaning.type_customers(adapters.raw_customers(spark, sf)))
    named = lambda df, name: df.select(F.lit(name).alias("source"), "*")
    return named(tx, "transactions").unionByName(named(cu, "customers"))
