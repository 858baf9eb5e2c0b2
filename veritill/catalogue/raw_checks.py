"""Queries over the checks on raw data."""

from __future__ import annotations

from veritill.catalogue import adapters
from veritill.catalogue.adapters import AS_OF, brief
from veritill.catalogue.oracle import NOW, check_row, literal, parse, union, with_ctes
from veritill.catalogue.registry import query
from veritill.operators import validation
from veritill.operators.checks import run_rules, validation_table

_SOURCES = {"transactions": "raw_tx", "customers": "raw_cu"}


# --------------------------------------------------------------------------- SQL of the checks
def not_empty(label: str) -> str:
    source = f"(SELECT COUNT(*) AS n FROM {_SOURCES[label]})"
    return check_row(
        label, f"{label}.not_empty", "n > 0", "'error'", "'DataFrame has ' || n || ' rows.'", "0", source
    )


def columns(label: str, check: str, severity: str, message: str, passed: bool = True) -> str:
    source = f"(SELECT COUNT(*) AS n FROM {_SOURCES[label]})"
    return check_row(label, f"{label}.{check}", str(passed).upper(), f"'{severity}'", literal(message), "0", source)


def pk(label: str, key: str) -> str:
    """Nulls are equal to each other, so they form one group."""
    source = f"""(SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS n FROM
        (SELECT COUNT(*) AS c FROM {_SOURCES[label]} GROUP BY "{key}"))"""
    message = f"n || ' duplicate values in {key}.'"
    return check_row(label, f"{label}.pk_unique.{key}", "n = 0", "'error'", message, "n", source)


def nulls(label: str, column: str, severity: str | None = None) -> str:
    source = f"""(SELECT COUNT(*) - COUNT("{column}") AS n, (COUNT(*) - COUNT("{column}"))::DOUBLE
        / greatest(COUNT(*), 1) AS share FROM {_SOURCES[label]})"""
    level = f"'{severity}'" if severity else "CASE WHEN share > 0.05 THEN 'error' ELSE 'warning' END"
    message = f"n || ' nulls (' || format('{{:.1f}}', share * 100) || '%) in column {column}.'"
    return check_row(label, f"{label}.no_nulls.{column}", "n = 0", level, message, "n", source)


def positive(label: str, column: str, zero_ok: bool) -> str:
    operator, kind = ("<", "negative") if zero_ok else ("<=", "non-positive")
    source = f"""(SELECT COUNT(*) AS n FROM {_SOURCES[label]} WHERE TRY_CAST("{column}" AS DOUBLE) {operator} 0)"""
    message = f"n || ' rows with {kind} {column}.'"
    return check_row(label, f"{label}.positive.{column}", "n = 0", "'warning'", message, "n", source)


def future(label: str, column: str) -> str:
    quoted = f'"{column}"'
    source = f"(SELECT COUNT(*) AS n FROM {_SOURCES[label]} WHERE {parse(quoted)} > {NOW})"
    message = f"n || ' future-dated rows in {column}.'"
    return check_row(label, f"{label}.no_future.{column}", "n = 0", "'error'", message, "n", source)


_COMPLETE = ("required_columns", "error", "All required columns present.")
_TX_SUITE = [
    not_empty("transactions"),
    columns("transactions", *_COMPLETE),
    columns("transactions", "no_extra_columns", "warning", "No unexpected columns."),
    pk("transactions", "InvoiceNo"),
    positive("transactions", "UnitPrice", True),
    future("transactions", "InvoiceDate"),
    *[nulls("transactions", c) for c in ("InvoiceNo", "StockCode", "InvoiceDate")],
]
_CU_SUITE = [
    not_empty("customers"),
    columns("customers", *_COMPLETE),
    pk("customers", "CustomerID"),
    *[nulls("customers", c) for c in ("CustomerID", "Country")],
]
_SHORT_SUITE = [
    not_empty("transactions"),
    columns("transactions", *_COMPLETE),
    pk("transactions", "InvoiceNo"),
    positive("transactions", "UnitPrice", True),
    future("transactions", "InvoiceDate"),
    not_empty("customers"),
    columns("customers", *_COMPLETE),
    pk("customers", "CustomerID"),
    *[nulls("customers", c, "warning") for c in ("CustomerID", "Country")],
]


def _sql(*rows: str) -> str:
    return with_ctes(union(*rows), "raw_tx", "raw_cu")


def _tx(spark, sf, *rules):
    raw = adapters.raw_transactions(spark, sf)
    return brief(run_rules(raw, [r(raw) for r in rules], validation.STAGE, AS_OF))


# --------------------------------------------------------------------------- queries
@query("v01_not_empty", _sql(not_empty("transactions"), not_empty("customers")))
def v01(spark, sf):
    tx = run_rules(
        adapters.raw_transactions(spark, sf), [validation.not_empty("transactions")], validation.STAGE, AS_OF
    )
    cu = run_rules(adapters.raw_customers(spark, sf), [validation.not_empty("customers")], validation.STAGE, AS_OF)
    return brief(tx.unionByName(cu))


@query(
    "v02_required_columns",
    _sql(
        columns("transactions", "required_columns", "error", "Missing columns: ['StoreNo', 'Till']", False),
        not_empty("transactions"),
    ),
)
def v02(spark, sf):
    """A contract with two columns the export lacks."""
    names = ["InvoiceNo", "StoreNo", "Till"]
    return _tx(
        spark, sf,
        lambda raw: validation.required_columns(raw, "transactions", names),
        lambda raw: validation.not_empty("transactions"),
    )


@query(
    "v03_extra_columns",
    _sql(
        columns("transactions", "no_extra_columns", "warning", "Extra columns: ['Channel']", False),
        not_empty("transactions"),
    ),
)
def v03(spark, sf):
    """An export with a column no contract names."""
    raw = adapters.raw_transactions(spark, sf).withColumnRenamed("PaymentMethod", "Channel")
    rules = [validation.no_extra_columns(raw, "transactions"), validation.not_empty("transactions")]
    return brief(run_rules(raw, rules, validation.STAGE, AS_OF))


@query("v04_pk_unique", _sql(pk("transactions", "InvoiceNo"), pk("transactions", "CustomerID"), pk("customers", "CustomerID")))
def v04(spark, sf):
    tx = adapters.raw_transactions(spark, sf)
    cu = adapters.raw_customers(spark, sf)
    rules = [validation.primary_key_unique(tx, "transactions", k) for k in ("InvoiceNo", "CustomerID")]
    found = run_rules(tx, rules, validation.STAGE, AS_OF)
    cu_rules = [validation.primary_key_unique(cu, "customers", "CustomerID")]
    return brief(found.unionByName(run_rules(cu, cu_rules, validation.STAGE, AS_OF)))


_NULL_COLUMNS = ("InvoiceNo", "UnitPrice", "CustomerID", "Status")


@query("v05_no_nulls", _sql(*[nulls("transactions", c) for c in _NULL_COLUMNS]))
def v05(spark, sf):
    raw = adapters.raw_transactions(spark, sf)
    rules = validation.no_nulls(raw, "transactions", [*_NULL_COLUMNS, "NotDelivered"])
    return brief(run_rules(raw, rules, validation.STAGE, AS_OF))


@query("v06_positive", _sql(positive("transactions", "UnitPrice", True), positive("transactions", "Quantity", False)))
def v06(spark, sf):
    return _tx(
        spark, sf,
        lambda raw: validation.positive_values(raw, "transactions", "UnitPrice", allow_zero=True),
        lambda raw: validation.positive_values(raw, "transactions", "Quantity"),
    )


@query("v07_no_future", _sql(future("transactions", "InvoiceDate"), future("customers", "SignupDate")))
def v07(spark, sf):
    cu = adapters.raw_customers(spark, sf)
    signup = [validation.no_future_dates(cu, "customers", "SignupDate", AS_OF)]
    found = _tx(spark, sf, lambda raw: validation.no_future_dates(raw, "transactions", "InvoiceDate", AS_OF))
    return found.unionByName(brief(run_rules(cu, signup, validation.STAGE, AS_OF)))


@query("v08_tx_suite", _sql(*_TX_SUITE))
def v08(spark, sf):
    return brief(validation.validate_transactions(adapters.raw_transactions(spark, sf), AS_OF))


@query("v09_cu_suite", _sql(*_CU_SUITE))
def v09(spark, sf):
    return brief(validation.validate_customers(adapters.raw_customers(spark, sf), AS_OF))


@query(
    "v10_result_table",
    with_ctes(
        f"""SELECT '2002-01-01' AS run_date, "check", status, severity, message, rows_affected,
              '{AS_OF}' AS checked_at FROM ({union(*_TX_SUITE, *_CU_SUITE)})""",
        "raw_tx",
        "raw_cu",
    ),
)
def v10(spark, sf):
    tx, cu = adapters.raw_transactions(spark, sf), adapters.raw_customers(spark, sf)
    return adapters.plain(validation_table(validation.validate_raw(tx, cu, AS_OF, adapters.RUN_DATE)))


@query("v11_short_suite", _sql(*_SHORT_SUITE))
def v11(spark, sf):
    tx, cu = adapters.raw_transactions(spark, sf), adapters.raw_customers(spark, sf)
    return brief(validation.validate_for_dashboard(tx, cu, AS_OF))


@query(
    "v12_between",
    _sql(
        check_row(
            "transactions",
            "transactions.between.Quantity",
            "n = 0",
            "'warning'",
            "n || ' rows with Quantity out of range.'",
            "n",
            """(SELECT COUNT(*) AS n FROM raw_tx WHERE TRY_CAST("Quantity" AS DOUBLE) NOT BETWEEN -20 AND 40)""",
        )
    ),
)
def v12(spark, sf):
    return _tx(spark, sf, lambda raw: validation.between(raw, "transactions", "Quantity", -20, 40))
