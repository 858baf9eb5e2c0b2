"""Queries over the quality checks and the ad-hoc SQL checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritill.catalogue import adapters, frames
from veritill.catalogue.adapters import AS_OF, RUN_DATE, brief, plain
from veritill.catalogue.oracle import NOW, check_row, day_text, exact_ratio, union, with_ctes
from veritill.catalogue.registry import query
from veritill.operators import quality, views
from veritill.operators.cleaning import type_customers
from veritill.operators.checks import dq_table, run_rules

_TABLES = {"stg_customers": "clean_cu", "stg_transactions": "clean_tx", "fct_transactions": "fact"}
_VALID = "('completed', 'cancelled', 'refunded')"


# --------------------------------------------------------------------------- SQL of the checks
def pk(table: str, *keys: str, note: bool = False) -> str:
    columns = ", ".join(f'"{k}"' for k in keys)
    source = f"""(SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS n FROM
        (SELECT COUNT(*) AS c FROM {_TABLES[table]} GROUP BY {columns}))"""
    check = f"pk_duplicates.{'_'.join(keys)}"
    if note:
        text = "CASE WHEN n > 0 THEN n || ' (multi-line invoices)' ELSE '—' END"
        return check_row(table, check, "TRUE", "'note'", text, "n", source, ("INFO", "INFO"))
    text = f"n || ' duplicate values in {keys[0]}.'"
    if len(keys) > 1:
        text = f"n || ' duplicate ({', '.join(keys)}) pairs.'"
    return check_row(table, check, "n = 0", "'error'", text, "n", source)


def null_rate(table: str, column: str, threshold: float = 0.05, severity: str | None = None) -> str:
    source = f"""(SELECT COUNT(*) - COUNT("{column}") AS n, (COUNT(*) - COUNT("{column}"))::DOUBLE
        / greatest(COUNT(*), 1) AS share FROM {_TABLES[table]})"""
    level = f"'{severity}'" if severity else "CASE WHEN share > 0.10 THEN 'error' ELSE 'warning' END"
    text = f"'Null rate in {column}: ' || format('{{:.2f}}', share * 100) || '% (' || n || ' rows).'"
    return check_row(table, f"null_rate.{column}", f"share <= {threshold}", level, text, "n", source)


def row_count(table: str, low: int, high: int | None = None) -> str:
    source = f"(SELECT COUNT(*) AS n FROM {_TABLES[table]})"
    inside = f"n >= {low}" + (f" AND n <= {high}" if high else "")
    limits = f"[{low:,}, {f'{high:,}' if high else '∞'}]"
    start = "'Row count ' || format('{:,}', n)"
    text = f"""CASE WHEN {inside} THEN {start} || ' within expected range.'
        ELSE {start} || ' is outside expected range {limits}.' END"""
    return check_row(table, "row_count_expectation", inside, "'error'", text, "0", source)


def status(table: str) -> str:
    source = f"""(SELECT COUNT(*) AS n FROM {_TABLES[table]} WHERE "Status" IS NULL OR "Status" NOT IN {_VALID})"""
    text = "n || ' rows with unexpected Status value.'"
    return check_row(table, "valid_status.Status", "n = 0", "'warning'", text, "n", source)


def sign(source_table: str = "fact") -> str:
    source = f"""(SELECT COUNT(*) AS n FROM {source_table} WHERE "Quantity" < 0 AND "LineTotal" > 0)"""
    text = "n || ' rows where negative Quantity has positive LineTotal.'"
    return check_row("fct_transactions", "line_total_sign", "n = 0", "'warning'", text, "n", source)


def orphans() -> str:
    source = """(SELECT COUNT(*) AS n FROM clean_tx t WHERE "CustomerID" IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM clean_cu c WHERE c."CustomerID" = t."CustomerID"))"""
    text = "n || ' transactions have no matching customer.'"
    return check_row("fct_transactions", "orphan_transactions", "n = 0", "'warning'", text, "n", source)


SUITE = union(
    pk("stg_customers", "CustomerID"),
    null_rate("stg_customers", "CustomerID"),
    null_rate("stg_customers", "Country"),
    row_count("stg_customers", 100),
    pk("stg_transactions", "InvoiceNo"),
    pk("stg_transactions", "InvoiceNo", "StockCode"),
    *[null_rate("stg_transactions", c) for c in ("InvoiceNo", "InvoiceDate", "UnitPrice")],
    status("stg_transactions"),
    row_count("stg_transactions", 500),
    orphans(),
    sign(),
)
_DASHBOARD = union(
    pk("stg_customers", "CustomerID"),
    null_rate("stg_customers", "CustomerID", 0, "warning"),
    row_count("stg_customers", 100),
    pk("stg_transactions", "InvoiceNo", note=True),
    pk("stg_transactions", "InvoiceNo", "StockCode"),
    null_rate("stg_transactions", "InvoiceDate", 0, "warning"),
    status("stg_transactions"),
    orphans(),
    sign(),
)


def _sql(body: str, *ctes: str) -> str:
    return with_ctes(body, *(ctes or ("fact",)))


def _run(df, *rules):
    return brief(run_rules(df, rules, quality.STAGE, AS_OF))


# --------------------------------------------------------------------------- rule queries
@query("q01_pk", _sql(union(pk("stg_transactions", "InvoiceNo"), pk("stg_transactions", "CustomerID"))))
def q01(spark, sf):
    tx = frames.clean_tx(spark, sf)
    rules = [quality.pk_duplicates(tx, "stg_transactions", k) for k in ("InvoiceNo", "CustomerID")]
    return _run(tx, *rules)


@query(
    "q02_compound_pk",
    _sql(
        pk("stg_transactions", "InvoiceNo", "StockCode").replace("FROM clean_tx", "FROM typed_tx"), "typed_tx"
    ),
)
def q02(spark, sf):
    """Before de-duplication, so that there is something to find."""
    tx = frames.typed_tx(spark, sf)
    return _run(tx, quality.compound_key_duplicates(tx, "stg_transactions"))


_RATED = ("CustomerID", "Status", "Country", "UnitPrice")


@query("q03_null_rates", _sql(union(*[null_rate("stg_transactions", c) for c in _RATED]), "clean_tx"))
def q03(spark, sf):
    tx = frames.clean_tx(spark, sf)
    return _run(tx, *quality.null_rates(tx, "stg_transactions", [*_RATED, "NotDelivered"]))


@query("q04_row_count", _sql(union(row_count("stg_transactions", 500), row_count("stg_transactions", 10, 1000)), "clean_tx"))
def q04(spark, sf):
    limits = [quality.row_count("stg_transactions", 500), quality.row_count("stg_transactions", 10, 1000)]
    return _run(frames.clean_tx(spark, sf), *limits)


@query("q05_status", _sql(status("stg_transactions"), "clean_tx"))
def q05(spark, sf):
    tx = frames.clean_tx(spark, sf)
    return _run(tx, quality.valid_status(tx, "stg_transactions"))


@query(
    "q06_sign",
    _sql(
        sign("""(SELECT "Quantity", abs("LineTotal") AS "LineTotal" FROM clean_tx)"""), "clean_tx"
    ),
)
def q06(spark, sf):
    """Totals without their sign, so that every return is a mismatch."""
    tx = frames.clean_tx(spark, sf).withColumn("LineTotal", F.abs("LineTotal"))
    return _run(tx, quality.line_total_sign(tx, "fct_transactions"))


@query("q07_orphans", _sql(orphans()))
def q07(spark, sf):
    fact, cu = frames.fact(spark, sf, holidays=False), frames.clean_cu(spark, sf)
    return _run(fact, quality.orphan_transactions(fact, cu))


@query("q08_suite", _sql(SUITE))
def q08(spark, sf):
    tx, cu, fact = frames.checked_layers(spark, sf)
    return brief(quality.run_quality_checks(tx, cu, fact, AS_OF))


@query(
    "q09_result_table",
    _sql(
        f"""SELECT '{RUN_DATE}' AS run_date, "table", "check", status, severity, message, rows_affected,
              '{AS_OF}' AS checked_at FROM ({SUITE})"""
    ),
)
def q09(spark, sf):
    tx, cu, fact = frames.checked_layers(spark, sf)
    return plain(dq_table(quality.run_quality_checks(tx, cu, fact, AS_OF, RUN_DATE)))


@query("q10_strict_suite", _sql(_DASHBOARD))
def q10(spark, sf):
    tx, cu, fact = frames.checked_layers(spark, sf)
    return brief(quality.run_dashboard_checks(tx, cu, fact, AS_OF))


# --------------------------------------------------------------------------- ad-hoc SQL checks
@query(
    "q11_duplicate_customers",
    _sql('SELECT COUNT(*) - COUNT(DISTINCT "CustomerID") AS duplicates FROM typed_cu', "typed_cu"),
)
def q11(spark, sf):
    return views.sql_duplicate_customers(type_customers(adapters.raw_customers(spark, sf)))


@query(
    "q12_duplicate_pairs",
    _sql(
        """SELECT COUNT(*) - COUNT(DISTINCT ("InvoiceNo" || '|' || "StockCode")) AS duplicates FROM typed_tx""",
        "typed_tx",
    ),
)
def q12(spark, sf):
    return views.sql_duplicate_pairs(frames.typed_tx(spark, sf))


@query(
    "q13_null_rates",
    _sql(
        "SELECT "
        + ", ".join(
            f"""{exact_ratio(f'COUNT(*) - COUNT("{c}")', "COUNT(*)", 0, 4)} AS "null_rate_{c}" """
            for c in ("InvoiceNo", "InvoiceDate", "UnitPrice", "CustomerID")
        )
        + " FROM typed_tx",
        "typed_tx",
    ),
)
def q13(spark, sf):
    return plain(views.sql_null_rates(frames.typed_tx(spark, sf)))


@query("q14_negative_prices", _sql('SELECT COUNT(*) AS count_negative_price FROM typed_tx WHERE "UnitPrice" < 0', "typed_tx"))
def q14(spark, sf):
    return views.sql_negative_prices(frames.typed_tx(spark, sf))


@query("q15_future_dates", _sql(f'SELECT COUNT(*) AS count_future FROM typed_tx WHERE "InvoiceDate" > {NOW}', "typed_tx"))
def q15(spark, sf):
    return views.sql_future_dates(frames.typed_tx(spark, sf), AS_OF)


@query(
    "q16_unexpected_status",
    _sql(
        f"""SELECT "Status", COUNT(*) AS row_count FROM clean_tx WHERE "Status" NOT IN {_VALID}
            GROUP BY 1 ORDER BY 2 DESC, 1""",
        "clean_tx",
    ),
)
def q16(spark, sf):
    return views.sql_unexpected_status(frames.clean_tx(spark, sf))


@query("q17_sign_mismatches", _sql('SELECT COUNT(*) AS mismatches FROM fact WHERE "Quantity" < 0 AND "LineTotal" > 0'))
def q17(spark, sf):
    return views.sql_sign_mismatches(frames.fact(spark, sf))


@query(
    "q18_daily_volume",
    _sql(
        f"""SELECT {day_text('"InvoiceDate"')} AS tx_date, COUNT(*) AS tx_count,
              CAST(SUM(CAST("LineTotal" AS DECIMAL(14, 4))) AS DOUBLE) AS daily_revenue,
              {exact_ratio('SUM(CAST("UnitPrice" AS DECIMAL(12, 4)))', 'COUNT("UnitPrice")', 4, 4)} AS avg_unit_price
            FROM fact GROUP BY 1 ORDER BY 1"""
    ),
)
def q18(spark, sf):
    return plain(views.sql_daily_volume(frames.fact(spark, sf)))


@query(
    "q19_row_counts",
    _sql(
        """SELECT 'row count: stg_transactions' AS source, COUNT(*) AS rows FROM clean_tx
           UNION ALL SELECT 'row count: fct_transactions', COUNT(*) FROM fact
           UNION ALL SELECT 'row count: stg_customers', COUNT(*) FROM clean_cu"""
    ),
)
def q19(spark, sf):
    return views.sql_row_counts(frames.clean_tx(spark, sf), frames.fact(spark, sf), frames.clean_cu(spark, sf))


@query(
    "q20_latest_run_summary",
    _sql(
        f"""SELECT '2002-01-02' AS run_date, status, severity, COUNT(*) AS check_count
            FROM ({SUITE}) GROUP BY ALL ORDER BY status, severity"""
    ),
)
def q20(spark, sf):
    """Two runs in the history; the newer one is summarised."""
    tx, cu, fact = frames.checked_layers(spark, sf)
    found = dq_table(quality.run_quality_checks(tx, cu, fact, AS_OF, RUN_DATE))
    runs = F.explode(F.array(F.col("run_date"), F.date_add("run_date", 1)))
    return plain(views.sql_latest_run_summary(found.withColumn("run_date", runs)))
