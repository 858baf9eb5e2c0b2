from __future__ import annotations

import pytest
from fixtures import dirty_customers, dirty_transactions

from veritill.operators import cleaning


@pytest.fixture()
def split(spark, as_of):
    return cleaning.clean_transactions(dirty_transactions(spark), as_of)


def test_reasons_are_joined_in_rule_order(split, rows):
    reasons = {r["InvoiceNo"]: r["_reject_reason"] for r in rows(split.rejected)}
    assert reasons == {
        "I3": "bad_date",
        "I4": "negative_price",
        "I5": "bad_unit_price|bad_quantity|future_date",
    }


def test_clean_rows(split, rows):
    clean = {(r["InvoiceNo"], r["StockCode"]): r for r in rows(split.clean)}
    assert set(clean) == {("I1", "S1"), ("I2", "S2"), ("I6", "S6"), (None, "S7")}
    first = clean["I1", "S1"]
    assert first["Description"] == "Blue Kettle"  # the first copy wins
    assert first["LineTotal"] == 12.5
    assert (first["TxYear"], first["TxMonth"], first["TxDay"], first["TxDOW"]) == (2023, 1, 15, "Sunday")
    assert clean["I2", "S2"]["Description"] == "T-Light 3D O'Neil"
    assert clean["I2", "S2"]["Status"] == "cancelled"
    assert clean["I2", "S2"]["LineTotal"] == -2.0
    assert clean["I2", "S2"]["Country"] == "United Kingdom"
    assert clean["I6", "S6"]["Status"] == "on hold"
    assert clean[None, "S7"]["Description"] == "No Invoice"  # null keys equal each other
    assert "_row_id" not in split.clean.columns and "_reject_reason" not in split.clean.columns


def test_nothing_rejected_gives_an_empty_quarantine(spark, as_of):
    good = dirty_transactions(spark).where("InvoiceNo = 'I1'")
    split = cleaning.clean_transactions(good, as_of)
    assert split.rejected.count() == 0 and split.clean.count() == 1
    assert "_reject_reason" in split.rejected.columns


def test_optional_columns_may_be_absent(spark, as_of):
    slim = dirty_transactions(spark).drop("Description", "Status", "PaymentMethod", "CustomerID")
    assert cleaning.clean_transactions(slim, as_of).clean.count() == 4


@pytest.mark.parametrize("parts", [1, 8])
def test_keep_first_does_not_depend_on_partitions(spark, as_of, parts, rows):
    raw = dirty_transactions(spark).repartition(parts)
    kept = rows(cleaning.clean_transactions(raw, as_of).clean.where("InvoiceNo = 'I1'"))
    assert [r["Description"] for r in kept] == ["Blue Kettle"]
    cu = rows(cleaning.clean_customers(dirty_customers(spark).repartition(parts)).clean.where("CustomerID = 'C1'"))
    assert [r["Country"] for r in cu] == ["United Kingdom"]


def test_keep_first_limits_before_the_shuffle(spark, as_of):
    plan = cleaning.clean_transactions(dirty_transactions(spark), as_of).clean
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_one_key_with_most_rows(spark, as_of, rows):
    """Thousands of copies of one key leave one row, whatever else is there."""
    raw = dirty_transactions(spark).where("InvoiceNo = 'I1' and _row_id = 1")
    copies = raw.crossJoin(spark.range(5000)).drop("_row_id").withColumnRenamed("id", "_row_id")
    assert cleaning.clean_transactions(copies, as_of).clean.count() == 1


def test_customers(spark, rows):
    split = cleaning.clean_customers(dirty_customers(spark))
    clean = {r["CustomerID"]: r for r in rows(split.clean)}
    assert set(clean) == {"C1", "C2", "C3", "C4"}
    assert [clean[c]["Country"] for c in ("C1", "C2", "C3", "C4")] == [
        "United Kingdom", "Germany", "United Kingdom", "Ireland",
    ]
    assert [clean[c]["IsActive"] for c in ("C1", "C2", "C3", "C4")] == [True, False, True, None]
    assert clean["C2"]["SignupDate"] is None and clean["C3"]["Segment"] == "online"
    assert [r["CustomerID"] for r in rows(split.rejected)] == [None]
    assert "_reject_reason" not in split.rejected.columns


def test_counters_add_up(spark, as_of, rows):
    typed = cleaning.type_transactions(dirty_transactions(spark))
    assert rows(cleaning.transaction_counters(typed, as_of)) == [
        {"raw_rows": 9, "clean_rows": 4, "rejected_rows": 3, "duplicate_rows": 2}
    ]
    cu = cleaning.customer_counters(cleaning.type_customers(dirty_customers(spark)))
    assert rows(cu) == [{"raw_rows": 6, "clean_rows": 4, "rejected_rows": 1, "duplicate_rows": 1}]


def test_reject_histogram(split, rows):
    assert [r["row_count"] for r in rows(cleaning.reject_histogram(split.rejected))] == [1, 1, 1]


def test_without_row_ids_the_other_columns_decide(spark, as_of, rows):
    raw = dirty_transactions(spark).drop("_row_id")
    kept = [rows(cleaning.clean_transactions(raw.repartition(n), as_of).clean, "InvoiceNo") for n in (1, 8)]
    assert kept[0] == kept[1] and len(kept[0]) == 4
