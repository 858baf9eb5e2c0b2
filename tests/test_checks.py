from __future__ import annotations

import pytest
from fixtures import dirty_customers, dirty_transactions, steady_customers, steady_fact
from pyspark.sql import functions as F

from veritill.model import DQ_RESULTS, RESULTS
from veritill.operators import checks, quality, validation
from veritill.operators.checks import run_rules


@pytest.fixture()
def run(as_of, rows):
    def results(df, *rules, stage="validation"):
        return {r["check"]: r for r in rows(run_rules(df, list(rules), stage, as_of, "2024-06-30"))}

    return results


def frame(spark, values, column="K", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{column} {dtype}")


def test_result_schema(spark, as_of):
    results = validation.validate_raw(dirty_transactions(spark), dirty_customers(spark), as_of, "2024-06-30")
    assert [(f.name, f.dataType) for f in results.schema] == [(f.name, f.dataType) for f in RESULTS]
    assert results.count() == 14
    assert checks.dq_table(results).schema.names == DQ_RESULTS.names


def test_not_empty(spark, run):
    assert run(frame(spark, ["a"]), validation.not_empty("t"))["t.not_empty"]["passed"]
    empty = run(frame(spark, []), validation.not_empty("t"))["t.not_empty"]
    assert (empty["status"], empty["severity"], empty["message"]) == ("FAIL", "error", "DataFrame has 0 rows.")


def test_column_contract(spark, run):
    df = dirty_transactions(spark).drop("Country").withColumn("Channel", F.lit("web"))
    found = run(df, validation.required_columns(df, "transactions"), validation.no_extra_columns(df, "transactions"))
    required = found["transactions.required_columns"]
    assert not required["passed"] and "Country" in required["details"]["missing"]
    extra = found["transactions.no_extra_columns"]
    assert not extra["passed"] and extra["severity"] == "warning" and "_row_id" not in extra["message"]
    assert run(df, validation.no_extra_columns(df, "unknown"))["unknown.no_extra_columns"]["passed"]


@pytest.mark.parametrize(("values", "surplus"), [(["a", "a", "b"], 1), (["a", None, None, None], 2), ([], 0)])
def test_primary_key(spark, run, values, surplus):
    df = frame(spark, values)
    found = run(df, validation.primary_key_unique(df, "t", "K"))["t.pk_unique.K"]
    assert (found["rows_affected"], found["passed"]) == (surplus, surplus == 0)
    missing = run(df, validation.primary_key_unique(df, "t", "Other"))["t.pk_unique.Other"]
    assert missing["passed"] and missing["rows_affected"] == 0


def test_nulls(spark, run):
    df = frame(spark, [None] + ["x"] * 19)
    found = run(df, *validation.no_nulls(df, "t", ["K", "Absent"]))
    assert list(found) == ["t.no_nulls.K"]
    assert found["t.no_nulls.K"]["severity"] == "warning" and not found["t.no_nulls.K"]["passed"]
    assert found["t.no_nulls.K"]["message"] == "1 nulls (5.0%) in column K."
    many = run(frame(spark, [None, "x"]), *validation.no_nulls(df, "t", ["K"]))["t.no_nulls.K"]
    assert many["severity"] == "error" and many["rows_affected"] == 1


def test_positive_and_future(spark, run, as_of):
    prices = frame(spark, ["-1", "0", "2", "x", None])
    strict = validation.positive_values(prices, "t", "K")
    loose = validation.positive_values(prices, "t", "K", allow_zero=True)
    assert run(prices, strict)["t.positive.K"]["rows_affected"] == 2
    assert run(prices, loose)["t.positive.K"]["message"] == "1 rows with negative K."
    dates = frame(spark, ["2099-01-01", "2020-01-01", "junk", None])
    assert run(dates, validation.no_future_dates(dates, "t", "K", as_of))["t.no_future.K"]["rows_affected"] == 1
    absent = run(dates, validation.no_future_dates(dates, "t", "D", as_of), validation.positive_values(dates, "t", "P"))
    assert all(r["passed"] and r["severity"] == "info" for r in absent.values())


def test_range_rule(spark, run):
    df = frame(spark, ["-5", "0", "9", None])
    assert run(df, validation.between(df, "t", "K", 0, 5))["t.between.K"]["rows_affected"] == 2


def test_short_suite_reports_nulls_as_warnings(spark, as_of, rows):
    found = rows(validation.validate_for_dashboard(dirty_transactions(spark), dirty_customers(spark), as_of))
    assert len(found) == 10
    assert {r["severity"] for r in found if "no_nulls" in r["check"]} == {"warning"}


def test_null_rate_thresholds(spark, run):
    df = frame(spark, [None] * 20 + ["x"] * 80)
    rule = lambda t: quality.null_rates(df, "t", ["K"], threshold=t)
    assert not run(df, *rule(0.10))["null_rate.K"]["passed"]
    assert run(df, *rule(0.20))["null_rate.K"]["passed"]
    one = frame(spark, [None] + ["x"] * 99)
    assert run(one, *quality.null_rates(one, "t", ["K"]))["null_rate.K"]["passed"]
    assert not run(one, *quality.null_rates(one, "t", ["K"], threshold=0.0))["null_rate.K"]["passed"]


def test_row_count(spark, run):
    df = frame(spark, ["a"] * 5)
    assert run(df, quality.row_count("t", 5, 5))["row_count_expectation"]["passed"]
    low = run(df, quality.row_count("t", 1000))["row_count_expectation"]
    assert low["message"] == "Row count 5 is outside expected range [1,000, ∞]." and low["rows_affected"] == 0


def test_status_and_sign(spark, run):
    df = frame(spark, ["completed", "UNKNOWN", None], "Status")
    assert run(df, quality.valid_status(df, "t"))["valid_status.Status"]["rows_affected"] == 2
    signs = spark.createDataFrame([(-5, 10.0), (3, 6.0), (-1, -2.0)], "Quantity int, LineTotal double")
    assert run(signs, quality.line_total_sign(signs, "t"))["line_total_sign"]["rows_affected"] == 1
    assert run(df, quality.line_total_sign(df, "t"))["line_total_sign"]["severity"] == "info"


def test_nested_keys_share_one_chain(spark, run):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "x"), ("a", "y"), ("b", None), ("b", None), (None, "z")], "InvoiceNo string, StockCode string"
    )
    found = run(df, quality.pk_duplicates(df, "t", "InvoiceNo"), quality.compound_key_duplicates(df, "t"))
    assert found["pk_duplicates.InvoiceNo"]["rows_affected"] == 3
    assert found["pk_duplicates.InvoiceNo_StockCode"]["rows_affected"] == 2
    chain = checks.surplus_rows(df, [("InvoiceNo", "StockCode"), ("InvoiceNo",)])
    assert chain._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_quality_suite(spark, as_of, rows):
    fact, cu = steady_fact(spark), steady_customers(spark)
    found = {(r["table"], r["check"]): r for r in rows(quality.run_quality_checks(fact, cu, fact, as_of))}
    assert len(found) == 13
    failed = {check for (_, check), r in found.items() if not r["passed"]}
    assert failed == {"row_count_expectation"}  # both tables are small
    ghosts = fact.withColumn("CustomerID", F.lit("GHOST"))
    orphans = rows(run_rules(ghosts, [quality.orphan_transactions(ghosts, cu)], "quality", as_of))
    assert orphans[0]["rows_affected"] == 60 and orphans[0]["severity"] == "warning"


def test_dashboard_suite_notes_invoices(spark, as_of, rows):
    fact, cu = steady_fact(spark), steady_customers(spark)
    doubled = fact.unionByName(fact.withColumn("StockCode", F.lit("other")))
    found = {r["check"]: r for r in rows(quality.run_dashboard_checks(doubled, cu, fact, as_of))}
    note = found["pk_duplicates.InvoiceNo"]
    assert (note["status"], note["severity"], note["message"]) == ("INFO", "note", "60 (multi-line invoices)")
    assert note["passed"]


def test_suites_scan_each_table_a_few_times(spark, as_of, tmp_path):
    path = str(tmp_path / "tx")
    dirty_transactions(spark).write.parquet(path)
    suite = validation.validate_transactions(spark.read.parquet(path), as_of)
    assert suite._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
