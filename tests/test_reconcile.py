"""Audits by content and duplicates of wide keys."""

from __future__ import annotations

import pytest
from fixtures import dirty_customers, dirty_transactions
from pyspark.sql import functions as F

from veritill.operators import reconcile, wide_keys
from veritill.operators.checks import surplus_rows
from veritill.operators.cleaning import clean_customers, clean_transactions


def _audit(found):
    return {r["layer"]: (r["expected_rows"], r["stored_rows"], r["same_rows"]) for r in found.collect()}


def test_one_swapped_row_is_found(spark, as_of):
    raw = dirty_transactions(spark)
    clean, rejected = clean_transactions(raw, as_of)
    again = lambda df: clean_transactions(df, as_of)
    assert _audit(reconcile.reconcile(raw, again, clean, rejected, "tx")) == {
        "tx_clean": (4, 4, True), "tx_rejected": (3, 3, True), "tx_duplicate": (2, 2, True)
    }
    names = sorted(r["InvoiceNo"] for r in clean.collect() if r["InvoiceNo"])
    swapped = clean.where(~F.col("InvoiceNo").eqNullSafe(names[0])).unionByName(clean.where(F.col("InvoiceNo") == names[1]).limit(1))
    found = _audit(reconcile.reconcile(raw, again, swapped, rejected, "tx"))
    assert found["tx_clean"] == (4, 4, False) and found["tx_duplicate"] == (2, 2, False) and found["tx_rejected"][2]
    assert not _audit(reconcile.reconcile(raw, again, clean.drop("Status"), rejected, "tx"))["tx_clean"][2]


def test_digests_are_of_multisets(spark):
    rows = [("a", 1), ("a", None), (None, 1), ("b", 2)]
    schema = "x string, y bigint"
    one = lambda found, parts=3: tuple(reconcile.digest(spark.createDataFrame(found, schema).repartition(parts)).first())
    assert one(rows) == one(rows[::-1], 1) and one(rows)[0] == 4
    assert one(rows)[1] != one([("a", 1), ("a", 1), (None, 1), ("b", 2)])[1]
    assert one([("a", None)])[1] != one([(None, None)])[1] and one([])[0] == 0
    assert one(rows + rows)[1] != one(rows)[1]


def test_customers_reconcile(spark):
    raw = dirty_customers(spark)
    clean, rejected = clean_customers(raw)
    assert all(row[2] for row in _audit(reconcile.reconcile(raw, clean_customers, clean, rejected, "cu")).values())


@pytest.mark.parametrize("collide", [False, True])
def test_wide_keys(spark, monkeypatch, collide):
    """Also where different keys share a fingerprint."""
    if collide:
        monkeypatch.setattr(wide_keys, "fingerprint", lambda keys: F.pmod(F.xxhash64(*keys), F.lit(5)))
    rows = [(f"k{i % 40}" if i % 7 else None, "long" * 50 + str(i % 3), i) for i in range(300)] + [("once", "only", 1)]
    df = spark.createDataFrame(rows, "a string, b string, v bigint").repartition(4)
    keys = ["a", "b"]
    found = {(r["a"], r["b"]): r["row_count"] for r in wide_keys.duplicate_keys(df, keys).collect()}
    assert found == {(r["a"], r["b"]): r["count"] for r in df.groupBy(*keys).count().where("count > 1").collect()}
    assert wide_keys.surplus_of(df, keys).first()["surplus_rows"] == surplus_rows(df, [keys]).first()[0]
    assert tuple(wide_keys.surplus_of(df.where("false"), keys).first()) == (0, 0)


def test_keys_that_occur_once_are_not_shuffled(spark):
    df = spark.range(0, 20_000, 1, 8).selectExpr("concat('x', if(id < 10, 0, id)) as a", "repeat(cast(id % 9 as string), 200) as b")
    assert wide_keys.recurring(df, ["a"]).count() == 1
    found = wide_keys.duplicate_keys(df, ["a"]).collect()
    assert [(r["a"], r["row_count"]) for r in found] == [("x0", 10)]


def test_sums_of_hashes_are_exact_and_need_no_decimal_per_row(spark):
    found = [-(1 << 63), (1 << 63) - 1, -1, 0, 5, (1 << 62) + 12345, -(1 << 62) - 777, (1 << 63) - 1]
    df = spark.createDataFrame([(h,) for h in found], "h bigint").repartition(3)
    total = df.agg(reconcile._sum_of(F.col("h")).alias("t"))
    assert int(total.first()["t"]) == sum(found) % reconcile.MODULUS
    partial = next(line for line in total._jdf.queryExecution().executedPlan().toString().splitlines() if "partial_sum" in line)
    assert "decimal" not in partial
