from __future__ import annotations

import pytest
from fixtures import dirty_customers, dirty_transactions, holidays
from pyspark.sql import functions as F

from veritill.model import FCT_TRANSACTIONS
from veritill.operators import cleaning, enrich, skew


@pytest.fixture()
def parts(spark, as_of):
    tx = cleaning.clean_transactions(dirty_transactions(spark), as_of).clean
    return tx, cleaning.clean_customers(dirty_customers(spark)).clean, holidays(spark)


@pytest.mark.parametrize("salted", [False, True])
def test_fact(parts, rows, salted):
    tx, cu, calendar = parts
    fact = enrich.build_fact(tx, cu, calendar, salted=salted)
    assert sorted(fact.columns) == sorted(FCT_TRANSACTIONS.names) and len(fact.columns) == 25
    found = {r["InvoiceNo"]: r for r in rows(fact)}
    assert fact.count() == tx.count()
    assert found["I1"]["is_known_customer"] and found["I1"]["CustomerSegment"] == "retail"
    assert found["I1"]["customer_tenure_days"] == 1110
    assert found["I1"]["is_holiday"] and found["I1"]["holiday_name"] == "A Day"
    assert not found["I2"]["is_holiday"]  # a German day, a British sale
    assert found["I2"]["customer_tenure_days"] is None
    assert found["I6"]["CountryISO2"] is None and not found["I6"]["is_holiday"]  # null matches nothing
    assert not found[None]["is_known_customer"] and found["I1"]["TxWeek"] == 2


def test_known_flag_can_follow_the_segment(spark, rows):
    tx = spark.createDataFrame([("I1", "C4"), ("I2", "X")], "InvoiceNo string, CustomerID string")
    cu = cleaning.clean_customers(dirty_customers(spark)).clean
    flags = lambda **kw: {r["InvoiceNo"]: r["is_known_customer"] for r in rows(enrich.join_customers(tx, cu, **kw))}
    assert flags() == {"I1": True, "I2": False}
    assert flags(strict_reference=True) == {"I1": False, "I2": False}


def test_without_calendar_nothing_is_a_holiday(parts):
    tx, cu, _ = parts
    assert enrich.build_fact(tx, cu).where("is_holiday or holiday_name is not null").count() == 0


def test_derived_columns_need_their_inputs(spark, rows):
    df = spark.createDataFrame([("2023-01-09",), ("2025-12-31",)], "d string")
    weeks = enrich.derive_columns(df.select(F.col("d").cast("timestamp").alias("InvoiceDate")))
    assert sorted(r["TxWeek"] for r in rows(weeks)) == [1, 2]
    assert "customer_tenure_days" not in weeks.columns
    codes = enrich.derive_columns(spark.createDataFrame([("Germany",), ("Unknown",)], "Country string"))
    assert {r["Country"]: r["CountryISO2"] for r in rows(codes)} == {"Germany": "DE", "Unknown": None}


def test_orphans_ignore_guests(spark, rows):
    tx = spark.createDataFrame([("C1",), ("GHOST",), ("GHOST",), (None,)], "CustomerID string")
    cu = spark.createDataFrame([("C1",), (None,)], "CustomerID string")
    assert rows(enrich.orphan_count(tx, cu)) == [{"orphan_count": 2}]
    assert rows(enrich.orphans_by_key(tx, cu)) == [{"CustomerID": "GHOST", "row_count": 2}]
    assert rows(enrich.orphan_count(tx.where("false"), cu)) == [{"orphan_count": 0}]


def test_salted_lookup_equals_plain_join_under_skew(spark):
    """A third of the rows on one key, a third without a key, the rest spread out."""
    facts = spark.range(9000).select(
        "id", F.expr("case id % 3 when 0 then 'hot' when 1 then null else concat('k', id % 500) end").alias("k")
    )
    dim = spark.range(400).selectExpr("concat('k', id) as k", "id as v").unionByName(
        spark.createDataFrame([("hot", -1), (None, -2)], "k string, v long")
    )
    plain = facts.join(dim.where("k is not null"), "k", "left").select("id", "k", "v")
    for salted in (False, True):
        got = skew.left_lookup(facts, dim.where("k is not null"), ["k"], salted=salted).select("id", "k", "v")
        assert got.count() == 9000
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_hot_keys_are_few_and_found(spark, rows):
    facts = spark.range(10000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) as k")
    assert rows(skew.hot_keys(facts, ["k"])) == [{"k": "hot"}]


def test_salting_spreads_a_hot_key_over_tasks(spark):
    facts = spark.range(20000).selectExpr("id", "if(id % 2 = 0, 'hot', concat('k', id)) as k")
    dim = spark.range(10).selectExpr("concat('k', id) as k", "id as v")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = skew.left_lookup(facts, dim, ["k"], salted=True)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20000 and max(sizes) < 0.3 * 20000
