"""Steps that must not shuffle the transactions once more, whatever the size of the tables beside them."""

from __future__ import annotations

import datetime as dt

import pytest

from veritill.catalogue import adapters, frames, reports
from veritill.operators import cleaning, enrich, quality
from veritill.plans import fact_upkeep
from veritill.sources import sinks

DAY = dt.datetime(1997, 3, 1)
ROWS = {
    "nation": [(0, "ALGERIA", 0)],
    "customer": [(1, "a", 0, 1.0, "AUTO"), (31, "b", 0, -1.0, None)],
    "part": [(1, "red pin", "b", "t", 1, 1.0), (3, "blue pin", "b", "t", 1, 1.0)],
    "orders": [(1, 1, "O", 1.0, DAY, "1-URGENT"), (2, 31, "F", 1.0, DAY, "5-LOW")],
    "lineitem": [
        (1, 1, 1, 1, 2.0, 10.0, 0.0, 0.0, "N", "O", DAY),
        (1, 1, 1, 2, 3.0, 12.0, 0.0, 0.0, "N", "O", DAY),
        (2, 3, 1, 3, 1.0, 5.0, 0.0, 0.0, "R", "F", DAY),
        (5, 9, 1, 1, 1.0, 5.0, 0.0, 0.0, "N", "O", DAY),
    ],
}


@pytest.fixture()
def unhinted(spark):
    """No dimension is small enough to be broadcast by its size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture()
def tables(spark, tmp_path):
    for name, found in ROWS.items():
        spark.createDataFrame(found, adapters.TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_uses_the_shuffle_by_invoice(unhinted, tables, rows):
    raw = adapters.raw_transactions(unhinted, tables)
    clean = cleaning.clean_transactions(raw, adapters.AS_OF).clean
    assert plan(clean).count("Exchange hashpartitioning") == plan(raw).count("Exchange hashpartitioning")
    assert [(r["InvoiceNo"], r["Quantity"], r["Description"], r["CustomerID"], r["Status"]) for r in rows(clean, "InvoiceNo")] == [
        ("1", 2.0, "Red Pin", "1", "completed"), ("2", -1.0, "Blue Pin", None, "cancelled"), ("5", 1.0, None, None, None),
    ]


def test_holidays_shuffle_no_transaction(unhinted, rows):
    tx = unhinted.createDataFrame([("I1", "Germany", DAY), ("I2", None, DAY), ("I3", "France", DAY)], "InvoiceNo string, Country string, InvoiceDate timestamp")
    days = unhinted.createDataFrame([("DE", DAY.date(), "b"), ("DE", DAY.date(), "a"), ("XX", DAY.date(), "c"), (None, None, "d")], "country_code string, date date, name string")
    found = enrich.enrich_holidays(tx, days)
    assert "SortMergeJoin" not in plan(found) and "BroadcastHashJoin" in plan(found)
    assert [(r["InvoiceNo"], r["holiday_name"], r["is_holiday"]) for r in rows(found, "InvoiceNo")] == [
        ("I1", "a", True), ("I2", None, False), ("I3", None, False),
    ]


def test_saved_fact_is_finished_behind_its_shuffle(spark, tmp_path, rows):
    tx = spark.createDataFrame([("I1", "Germany", DAY, 1997, 3)], "InvoiceNo string, Country string, InvoiceDate timestamp, TxYear int, TxMonth int")
    days = spark.createDataFrame([("DE", DAY.date(), "a")], "country_code string, date date, name string")
    assert sinks.save_fact(tx, f"{tmp_path}/fact", lambda df: enrich.finish_fact(df, days)) == 1
    found = rows(spark.read.parquet(f"{tmp_path}/fact"))[0]
    assert (found["holiday_name"], found["CountryISO2"], found["TxWeek"], found["TxYear"], found["TxMonth"]) == ("a", "DE", 9, 1997, 3)


def test_a_load_scans_for_unfit_rows_only_if_there_are_any(spark, tmp_path, monkeypatch):
    staged, stage = [], sinks._stage
    monkeypatch.setattr(sinks, "_stage", lambda df, *given: staged.append(df) or stage(df, *given))
    tx = spark.createDataFrame([("I1", 2.0), ("I2", 2.5), ("I3", None)], "InvoiceNo string, Quantity double")
    tx.write.parquet(f"{tmp_path}/tx")
    tx = spark.read.parquet(f"{tmp_path}/tx")
    load = lambda df: sinks.replace_table(df, f"{tmp_path}/warehouse", "stg_transactions", "2024-01-01")
    assert load(tx) == (2, 1) and staged[1].collect()[0]["unfit_columns"] == ["Quantity"]
    assert load(tx.where("InvoiceNo <> 'I2'")) == (2, 0)
    assert "FileScan" in plan(staged[2]) and "FileScan" not in plan(staged[3]) and staged[3].columns == staged[1].columns


def test_new_holidays_shuffle_no_fact(unhinted, rows):
    row = ("I1", "C1", "Germany", DAY, 1997, 3, "x", True, False, None, None, 9, "DE")
    fact = unhinted.createDataFrame([row], """InvoiceNo string, CustomerID string, Country string, InvoiceDate timestamp,
        TxYear int, TxMonth int, CustomerSegment string, is_known_customer boolean, is_holiday boolean,
        holiday_name string, customer_tenure_days int, TxWeek int, CountryISO2 string""").drop("customer_tenure_days")
    days = unhinted.createDataFrame([("DE", DAY.date(), "a")], "_iso2 string, _day date, holiday_name string")
    found = fact_upkeep._rebuilt(fact, None, days, {"Germany": "DE"})
    assert "TxYear" not in "".join(line for line in plan(found).split("\n") if "Exchange" in line) and "CustomerID#" not in plan(found).split("Exchange", 1)[-1]
    assert rows(found)[0] == fact.collect()[0].asDict() | {"is_holiday": True, "holiday_name": "a"}


def test_suites_store_only_what_they_check(unhinted, tables, rows):
    whole, narrow = frames.stored_layers(unhinted, tables), frames.checked_layers(unhinted, tables)
    assert [set(layer.columns) for layer in narrow] == [
        set(quality.CHECKED_TRANSACTIONS), set(quality.CHECKED_CUSTOMERS), set(quality.CHECKED_FACT)
    ]
    for suite in (quality.run_quality_checks, quality.run_dashboard_checks):
        found = [rows(suite(*layers, adapters.AS_OF), "position") for layers in (whole, narrow)]
        assert found[0] == found[1] and len(found[0]) >= 9


def test_exports_are_joined_by_the_number(unhinted, tables, rows):
    """No sort works out a text; the rows are the same."""
    by_text, by_number = (adapters.raw_transactions(unhinted, tables, exported=e) for e in (False, True))
    sorts = [line for line in plan(by_number).splitlines() if "Sort [" in line]
    assert sorts and not any("as string" in line for line in sorts)
    assert rows(by_text, "InvoiceNo", "_row_id") == rows(by_number, "InvoiceNo", "_row_id")


def test_report_figures_are_joined_by_the_number(unhinted, tables, rows, monkeypatch):
    """No sort below the headline figures or the rejected rows works out the invoice number's text."""
    seen = []
    monkeypatch.setattr(reports.analytics, "kpis", lambda fact, rejected: seen.extend((fact, rejected)) or unhinted.sql(
        "select 1 as tx_rows, 1 as total_revenue, 1 as rejected_rows"
    ))
    reports.r01_rejected(unhinted, tables)
    for found in seen:
        sorts = [line for line in plan(found).splitlines() if "Sort [" in line]
        assert sorts and not any("l_orderkey" in line and "as string" in line for line in sorts)
    assert rows(seen[0], "InvoiceNo") == rows(frames.fact(unhinted, tables), "InvoiceNo")
