"""Quality checks on clean and loaded tables (Q1-Q10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritill.functions import decimal_text, grouped_text, rate
from veritill.model import (
    MIN_CUSTOMERS,
    MIN_TRANSACTIONS,
    NULL_RATE_ERROR,
    NULL_RATE_THRESHOLD,
    TRANSACTION_KEY,
    VALID_STATUSES,
)
from veritill.operators.checks import Rule, Verdict, run_rules, union_results
from veritill.operators.validation import counted, duplicate_verdict, skipped

STAGE = "quality"
#: Every column that the suites below read, by layer.
CHECKED_TRANSACTIONS = ("InvoiceNo", "StockCode", "InvoiceDate", "UnitPrice", "Status")
CHECKED_CUSTOMERS = ("CustomerID", "Country")
CHECKED_FACT = ("CustomerID", "Quantity", "LineTotal")


# --------------------------------------------------------------------------- rules
def pk_duplicates(df: DataFrame, table: str, key: str, severity: str = "error") -> Rule:
    """Q1; ``severity="note"`` reports duplicates without failing."""
    check = f"pk_duplicates.{key}"
    if key not in df.columns:
        return skipped(check, table, f"0 duplicate values in {key}.", severity)
    if severity != "note":
        return Rule(check, table, lambda n, m: duplicate_verdict(m["surplus"], key, severity), unique=(key,))

    def note(n, m):
        text = F.when(m["surplus"] > 0, counted(m["surplus"], " (multi-line invoices)")).otherwise("—")
        return Verdict(True, "note", text, rows=m["surplus"])

    return Rule(check, table, note, unique=(key,), labels=("INFO", "INFO"))


def compound_key_duplicates(df: DataFrame, table: str, keys: Sequence[str] = TRANSACTION_KEY) -> Rule:
    """Q2: nulls equal each other in every part of the key."""

    def judge(n, m):
        text = counted(m["surplus"], f" duplicate ({', '.join(keys)}) pairs.")
        return Verdict(m["surplus"] == 0, "error", text, rows=m["surplus"])

    return Rule(f"pk_duplicates.{'_'.join(keys)}", table, judge, unique=tuple(keys))


def null_rates(
    df: DataFrame,
    table: str,
    columns: Sequence[str],
    threshold: float = NULL_RATE_THRESHOLD,
    severity: str | None = None,
) -> list[Rule]:
    """Q3: a threshold of zero means zero."""

    def rule(column: str) -> Rule:
        def judge(n, m):
            share = rate(m["nulls"], n)
            level = F.when(share > NULL_RATE_ERROR, "error").otherwise("warning")
            message = F.concat(
                F.lit(f"Null rate in {column}: "),
                decimal_text(share * 100, 2),
                F.lit("% ("),
                m["nulls"].cast("string"),
                F.lit(" rows)."),
            )
            return Verdict(
                share <= threshold,
                severity or level,
                message,
                rows=m["nulls"],
                metric=share,
                threshold=float(threshold),
                details={"null_rate": F.bround(share, 4), "threshold": str(threshold)},
            )

        return Rule(f"null_rate.{column}", table, judge, {"nulls": F.count_if(F.col(column).isNull())})

    return [rule(c) for c in columns if c in df.columns]


def row_count(table: str, min_rows: int, max_rows: int | None = None) -> Rule:
    """Q4: inclusive range."""

    def judge(n, m):
        inside = n >= min_rows
        if max_rows is not None:
            inside = inside & (n <= max_rows)
        limits = f"[{min_rows:,}, {max_rows if max_rows else '∞'}]"
        if max_rows:
            limits = f"[{min_rows:,}, {max_rows:,}]"
        start = F.concat(F.lit("Row count "), grouped_text(n))
        message = F.when(inside, F.concat(start, F.lit(" within expected range."))).otherwise(
            F.concat(start, F.lit(f" is outside expected range {limits}."))
        )
        details = {"row_count": n, "min_rows": str(min_rows), "max_rows": str(max_rows)}
        return Verdict(inside, "error", message, metric=n, details=details)

    return Rule("row_count_expectation", table, judge)


def valid_status(
    df: DataFrame,
    table: str,
    column: str = "Status",
    valid: Sequence[str] = VALID_STATUSES,
    missing_severity: str = "info",
) -> Rule:
    """Q5: null is not a valid value."""
    check = f"valid_status.{column}"
    if column not in df.columns:
        return skipped(check, table, f"Column {column} not present — skipped.", missing_severity)
    invalid = ~F.coalesce(F.col(column).isin(*valid), F.lit(False))

    def judge(n, m):
        text = counted(m["bad"], " rows with unexpected Status value.")
        return Verdict(m["bad"] == 0, "warning", text, rows=m["bad"], details={"valid_values": ", ".join(valid)})

    return Rule(check, table, judge, {"bad": F.count_if(invalid)})


def sign_mismatch() -> Column:
    return (F.col("Quantity") < 0) & (F.col("LineTotal") > 0)


def line_total_sign(df: DataFrame, table: str, missing_severity: str = "info") -> Rule:
    """Q6: a return must not earn money; the other direction is not checked."""
    if not {"Quantity", "LineTotal"} <= set(df.columns):
        message = "Quantity or LineTotal column missing — skipped."
        return skipped("line_total_sign", table, message, missing_severity)

    def judge(n, m):
        text = counted(m["bad"], " rows where negative Quantity has positive LineTotal.")
        return Verdict(m["bad"] == 0, "warning", text, rows=m["bad"])

    return Rule("line_total_sign", table, judge, {"bad": F.count_if(sign_mismatch())})


def orphan_transactions(
    facts: DataFrame, customers: DataFrame, key: str = "CustomerID", customer_key: str = "CustomerID"
) -> Rule:
    """Q7."""
    if key not in facts.columns or customer_key not in customers.columns:
        return skipped("orphan_transactions", "fct_transactions", "Key column missing — skipped.", "warning")

    def judge(n, m):
        text = counted(m["orphans"], " transactions have no matching customer.")
        return Verdict(m["orphans"] == 0, "warning", text, rows=m["orphans"])

    return Rule(
        "orphan_transactions", "fct_transactions", judge, reference=(customers, key, customer_key)
    )


# --------------------------------------------------------------------------- suites
def run_quality_checks(
    transactions: DataFrame,
    customers: DataFrame,
    fact: DataFrame,
    as_of,
    run_date=None,
    invoice_severity: str = "error",
) -> DataFrame:
    """Q8: the 13 checks of a run.

    ``invoice_severity="note"`` turns the InvoiceNo check into a note, as invoices have lines.
    """
    cu = "stg_customers"
    tx = "stg_transactions"
    cu_rules = [
        pk_duplicates(customers, cu, "CustomerID"),
        *null_rates(customers, cu, ["CustomerID", "Country"]),
        row_count(cu, MIN_CUSTOMERS),
    ]
    tx_rules = [pk_duplicates(transactions, tx, "InvoiceNo", invoice_severity)]
    if "StockCode" in transactions.columns:
        tx_rules.append(compound_key_duplicates(transactions, tx))
    tx_rules += [
        *null_rates(transactions, tx, ["InvoiceNo", "InvoiceDate", "UnitPrice"]),
        valid_status(transactions, tx),
        row_count(tx, MIN_TRANSACTIONS),
    ]
    fact_rules = [orphan_transactions(fact, customers), line_total_sign(fact, "fct_transactions")]
    return _suite(
        [(customers, cu_rules), (transactions, tx_rules), (fact, fact_rules)], as_of, run_date
    )


def run_dashboard_checks(transactions: DataFrame, customers: DataFrame, fact: DataFrame, as_of, run_date=None) -> DataFrame:
    """Q10: nine checks, in which any null fails and InvoiceNo duplicates are a note."""
    cu = "stg_customers"
    tx = "stg_transactions"
    cu_rules = [
        pk_duplicates(customers, cu, "CustomerID"),
        *null_rates(customers, cu, ["CustomerID"], threshold=0.0, severity="warning"),
        row_count(cu, MIN_CUSTOMERS),
    ]
    tx_rules = [
        pk_duplicates(transactions, tx, "InvoiceNo", severity="note"),
        compound_key_duplicates(transactions, tx),
        *null_rates(transactions, tx, ["InvoiceDate"], threshold=0.0, severity="warning"),
        valid_status(transactions, tx, missing_severity="warning"),
    ]
    fact_rules = [
        orphan_transactions(fact, customers),
        line_total_sign(fact, "fct_transactions", missing_severity="warning"),
    ]
    return _suite(
        [(customers, cu_rules), (transactions, tx_rules), (fact, fact_rules)], as_of, run_date
    )


def _suite(tables: Sequence[tuple[DataFrame, Sequence[Rule]]], as_of, run_date) -> DataFrame:
    parts, offset = [], 0
    for df, rules in tables:
        parts.append(run_rules(df, rules, STAGE, as_of, run_date, offset))
        offset += len(rules)
    return union_results(parts)
