from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from fixtures import dirty_customers, dirty_transactions, steady_fact
from pyspark.sql import functions as F

from veritill.operators import analytics
from veritill.operators.cleaning import type_transactions
from veritill.operators import quantiles as quantile_search
from veritill.operators.quantiles import exact_quantiles

QS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def quantiles(df, columns, qs=QS, **kw):
    return {(r["column"], r["quantile"]): r["value"] for r in exact_quantiles(df, columns, qs, **kw).collect()}


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0, 1.0, None, 1.0, 9.5], [2.0] * 50])
def test_quantiles_of_few_rows(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    known = [v for v in values if v is not None]
    expected = {("v", q): pytest.approx(np.quantile(known, q)) for q in QS}
    assert quantiles(df, ["v"]) == expected


@pytest.mark.parametrize("shape", ["spread", "hot"])
def test_quantiles_inside_narrow_brackets(spark, shape):
    """Few bins over many rows, so that several rounds close in on each rank."""
    if shape == "spread":
        df = spark.range(0, 20000, 1, 8).selectExpr("cast((id * 7919) % 20011 as double) / 7 as v", "cast(-id as double) as w")
    else:
        df = spark.range(0, 20000, 1, 8).selectExpr("if(id % 3 = 0, 5.0d, cast(id % 977 as double)) as v", "1.0d as w")
    pdf = df.toPandas()
    got = quantiles(df, ["v", "w"], bins=16)
    for column in ("v", "w"):
        for q in QS:
            assert got[column, q] == pytest.approx(np.quantile(pdf[column], q))


def test_quantiles_of_extreme_values(spark):
    values = [float("-inf"), -1.7e308, -5e-324, 0.0, 5e-324, 1.0, 1.7e308, 1.7e308, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quantiles(df, ["v"], [i / 8 for i in range(9)], bins=4)
    assert [got["v", i / 8] for i in range(9)] == values


def test_no_task_gets_more_than_bins(spark):
    """What leaves a task is one row per bin and rank."""
    df = spark.range(0, 50_000, 1, 4).selectExpr("cast(id * 7919 % 50021 as double) as v")
    open_ = [quantile_search._Search("v", 10, 0.0, 50_020.0, 0)]
    found = quantile_search._narrowed(df.selectExpr("'v' as column", "v as value", "1L as n"), open_, 64)[0]
    assert found.high - found.low <= 50_020 / 64 + 1 and found.below == 0


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_quantiles_scan_their_input_twice(spark, monkeypatch, accuracy):
    """However coarse the sketch; and what the brackets leave is a small part of the rows."""
    monkeypatch.setattr(quantile_search, "ACCURACY", accuracy)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(0, 30_000, 1, 4).selectExpr("cast(id * 7919 % 30011 as double) as v", "cast(id % 7 as double) as w")
    expected = {(c, q): np.quantile(df.toPandas()[c], q) for c in ("v", "w") for q in QS}
    got = quantiles(df.mapInArrow(count, df.schema), ["v", "w"], bins=32)
    assert got == {key: pytest.approx(value) for key, value in expected.items()}
    assert seen.value == 2 * 30_000


def test_brackets_that_miss_their_rank(spark, monkeypatch):
    """A wrong sketch costs a third scan, not a wrong value."""
    right = quantile_search.sketched

    def wrong(*args):
        return {c: s._replace(brackets=[(s.high, s.high) for _ in s.brackets]) for c, s in right(*args).items()}

    monkeypatch.setattr(quantile_search, "sketched", wrong)
    df = spark.range(0, 1000, 1, 4).selectExpr("cast(id as double) as v")
    assert quantiles(df, ["v"]) == {("v", q): pytest.approx(q * 999) for q in QS}


def test_sums_keep_large_amounts(spark):
    rows = [("A", 2e10), ("A", 10.0), ("B", None)]
    fact = spark.createDataFrame(rows, "Country string, LineTotal double")
    got = {r["Country"]: r["revenue"] for r in analytics.top_countries_by_revenue(fact).collect()}
    assert got == {"A": 20000000010, "B": None}
    with pytest.raises(Exception, match="does not fit"):
        analytics.top_countries_by_revenue(spark.createDataFrame([("A", 1e30)], "Country string, LineTotal double")).collect()


def test_daily_summary_and_kpis_copy_no_rows(spark, as_of):
    from veritill.operators import views
    from veritill.operators.cleaning import clean_transactions
    from veritill.operators.enrich import build_fact
    from veritill.operators.cleaning import clean_customers

    tx = clean_transactions(dirty_transactions(spark), as_of).clean
    fact = build_fact(tx, clean_customers(dirty_customers(spark)).clean)
    for frame in (views.daily_summary(tx), analytics.kpis(fact)):
        assert "Expand" not in frame._jdf.queryExecution().executedPlan().toString()


def test_quantiles_without_values(spark):
    assert quantiles(spark.createDataFrame([(None,)], "v double"), ["v"]) == {}


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"UnitPrice": [1.5, 2.25, 9.0, None, 3.3], "Quantity": [1.0, -5.0, 7.0, 2.0, None]})
    got = {r["column"]: r for r in analytics.describe(spark.createDataFrame(pdf)).collect()}
    expected = pdf.describe().round(2)
    for column in pdf:
        for ours, theirs in {"mean": "mean", "std": "std", "p25": "25%", "p50": "50%", "p75": "75%", "max": "max"}.items():
            assert got[column][ours] == pytest.approx(expected[column][theirs], abs=0.0101)


@pytest.mark.parametrize(("low", "high"), [(None, None), (-2, 6)])
def test_histogram_matches_numpy(spark, low, high):
    values = [((i * 37) % 101) / 7 - 3 for i in range(500)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    counts, edges = np.histogram(np.clip(values, low, high) if low is not None else values, bins=10)
    got = sorted(analytics.histogram(df, F.col("v"), 10, low, high).collect(), key=lambda r: r["bin"])
    assert [r["row_count"] for r in got] == counts.tolist()
    assert [r["bin_low"] for r in got] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_a_constant_and_of_nothing(spark):
    flat = spark.createDataFrame([(4.0,)] * 3, "v double")
    got = sorted(analytics.histogram(flat, F.col("v"), 2).collect(), key=lambda r: r["bin"])
    assert [(r["bin_low"], r["bin_high"], r["row_count"]) for r in got] == [(3.5, 4.0, 0), (4.0, 4.5, 3)]
    assert analytics.histogram(flat.where("false"), F.col("v"), 2).count() == 0


def test_profiles(spark, as_of, rows):
    typed = type_transactions(dirty_transactions(spark))
    assert rows(analytics.date_coverage(typed, as_of))[0]["future_dates"] == 1
    profile = rows(analytics.null_profile(typed.drop("_row_id")))
    assert profile[0]["column"] == "CustomerID" and all(r["null_rate"] > 0 for r in profile)
    surplus = {r["key"]: r["surplus"] for r in rows(analytics.duplicate_profile(typed, dirty_customers(spark)))}
    assert surplus == {"InvoiceNo": 2, "InvoiceNo+StockCode": 2, "CustomerID": 1}
    preview = {r["column"]: (r["dtype"], r["non_null"]) for r in rows(analytics.schema_preview(typed))}
    assert preview["UnitPrice"] == ("double", 8)


def test_reports_over_the_steady_fact(spark, rows):
    fact = steady_fact(spark).withColumns({"is_known_customer": F.lit(True), "CustomerSegment": F.lit("retail")})
    kpi = rows(analytics.kpis(fact))[0]
    assert (kpi["tx_rows"], kpi["unique_customers"], kpi["cancel_pct"], kpi["guest_pct"]) == (60, 20, 10.0, 0.0)
    assert [r["pct"] for r in rows(analytics.status_distribution(fact))] == [90.0, 10.0]
    assert len(rows(analytics.monthly_revenue(fact))) == 3
    grid = rows(analytics.weekday_hours(fact))
    assert grid[0]["dow"] == "Monday" and sum(r["00:00"] for r in grid) == 60 and grid[0]["22:00"] == 0
    assert rows(analytics.segment_revenue(fact))[0]["tx_count"] == 60
    assert rows(analytics.top_countries_by_count(fact)) == [{"Country": "United Kingdom", "row_count": 60}]
