"""Tables that grow by deliveries: the same as one big run, without reading or writing what did not change."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from veritill.operators import deliveries, rollups
from veritill.operators.cleaning import keep_first
from veritill.operators.enrich import build_fact
from veritill.plans import fact_upkeep
from veritill.sources import snapshots

ROWS = "a string, b bigint, v bigint, _row_id bigint"


def _frame(spark, rows):
    return spark.createDataFrame(rows, ROWS).repartition(3)


def _kept(spark, path):
    return sorted(map(str, (tuple(r) for r in snapshots.read(spark, path, "t").collect())))


def _parts(n, size, kinds):
    """Deliveries with keys that recur within and across them, nulls included."""
    return [
        [(None if (i * 7) % kinds == 0 else f"k{(i * 7 + d * 3) % kinds}", None if i % 5 == 0 else i % 3, d * 1000 + i, d * 1000 + i) for i in range(size)]
        for d in range(n)
    ]


@pytest.mark.parametrize("most, kinds", [(8, 40), (2, 40), (3, 1000)])
def test_deliveries_one_by_one_are_one_big_run(spark, tmp_path, monkeypatch, most, kinds):
    monkeypatch.setattr(deliveries, "MOST_PARTS", most)
    monkeypatch.setattr(deliveries, "RANGE_KEYS", 2)
    path, parts = str(tmp_path / "wh"), _parts(4, 60, kinds)
    found = [deliveries.deliver(_frame(spark, rows), path, "t", ["a", "b"], f"d{d}", "2024-01-01") for d, rows in enumerate(parts)]
    whole = keep_first(_frame(spark, [row for rows in parts for row in rows]), ["a", "b"])
    assert _kept(spark, path) == sorted(map(str, (tuple(r) for r in whole.collect())))
    assert sum(one.new for one in found) == whole.count() and sum(one.new + one.known for one in found) == 240
    assert len(snapshots.current(spark, path).tables["t_keys"]) < most or most == 2


def test_a_repeated_and_an_empty_delivery(spark, tmp_path):
    path, rows = str(tmp_path / "wh"), [("x", 1, 1, 1), ("x", 1, 2, 2)]
    assert deliveries.deliver(_frame(spark, rows), path, "t", ["a", "b"], "d1", "2024-01-01") == (1, 1)
    assert deliveries.deliver(_frame(spark, rows), path, "t", ["a", "b"], "d1", "2024-01-01") == (0, 0)
    assert deliveries.deliver(_frame(spark, []), path, "t", ["a", "b"], "d2", "2024-01-01") == (0, 0)
    assert deliveries.deliver(_frame(spark, rows), path, "t", ["a", "b"], "d3", "2024-01-01") == (0, 2)
    assert _kept(spark, path) == ["('x', 1, 1, 1)"]


def test_only_slots_that_can_hold_the_keys_are_opened(spark, tmp_path):
    path = str(tmp_path / "wh")
    deliveries.deliver(_frame(spark, [(f"k{i}", i, i, i) for i in range(500)]), path, "t", ["a", "b"], "d1", "2024-01-01")
    version = snapshots.current(spark, path)
    part = version.tables["t_keys"][0].path
    filters = snapshots.read(spark, path, "t_keys_filters")
    new = deliveries._hashed(_frame(spark, [(f"new{i}", i, i, i) for i in range(2000)]), ["a", "b"])
    assert deliveries.possibly_known(new, filters).count() < 40  # false positives only
    old = deliveries._hashed(_frame(spark, [("k7", 7, 0, 0), ("k7", 8, 0, 0)]), ["a", "b"])
    possible = deliveries.possibly_known(old, filters).collect()
    slots = {r["slot"] for r in possible}
    assert 1 <= len(slots) <= 2
    for slot in set(range(deliveries.SLOTS)) - slots:  # all other folders may be gone
        for file in Path(f"{path}/t_keys/{part}/slot={slot}").glob("*.parquet"):
            file.write_bytes(b"broken")
    known = deliveries.known_keys(spark, old, ["a", "b"], path, "t_keys", version)
    assert [(r["a"], r["b"]) for r in known.collect()] == [("k7", 7)]


def test_two_deliveries_at_the_same_time(spark, tmp_path):
    path = str(tmp_path / "wh")
    send = lambda d: deliveries.deliver(_frame(spark, [("same", 1, d, d), (f"own{d}", d, d, d)]), path, "t", ["a", "b"], f"d{d}", "2024-01-01")
    with ThreadPoolExecutor(2) as pool:
        found = list(pool.map(send, (1, 2)))
    assert sorted(found) == [(1, 1), (2, 0)] and len(_kept(spark, path)) == 3


# --------------------------------------------------------------------------- fact
TX = """InvoiceNo string, StockCode string, CustomerID string, Country string, InvoiceDate timestamp, Quantity double, UnitPrice double,
    TxYear int, TxMonth int, TxDay int"""


def _transactions(spark):
    rows = spark.range(60).selectExpr(
        "concat('I', id) as InvoiceNo", "'S' as StockCode", "if(id % 10 = 9, null, concat(' C', id % 6, ' ')) as CustomerID",
        "if(id % 2 = 0, 'Germany', 'France') as Country", "timestamp(date_add(date'2024-01-05', cast(id % 4 as int) * 31)) as InvoiceDate",
        "1.0D as Quantity", "2.0D as UnitPrice",
    )
    # customer 5 buys in one month only
    rows = rows.withColumn("InvoiceDate", F.when(F.trim("CustomerID") == "C5", F.lit("2024-02-05").cast("timestamp")).otherwise(F.col("InvoiceDate")))
    return rows.selectExpr("*", "year(InvoiceDate) as TxYear", "month(InvoiceDate) as TxMonth", "day(InvoiceDate) as TxDay")


def _customers(spark, rows):
    return spark.createDataFrame(rows, "CustomerID string, Country string, SignupDate timestamp, Segment string, IsActive boolean")


def _holidays(spark, rows):
    return spark.createDataFrame(rows, "country_code string, date string, local_name string, name string, is_global boolean").withColumn(
        "date", F.col("date").cast("date"))


def _same(a, b):
    return a.exceptAll(b.select(*a.columns)).count() == 0 == b.select(*a.columns).exceptAll(a).count()


def test_a_late_file_rewrites_its_months_only(spark, tmp_path):
    path, tx = str(tmp_path / "wh"), _transactions(spark)
    first = _customers(spark, [(f"C{i}", "Spain", None, "retail", True) for i in range(5)])
    late = _customers(spark, [(f"C{i}", "Spain", None, "retail", True) for i in range(6)])
    none, days = _holidays(spark, []), _holidays(spark, [("FR", "2024-04-07", "x", "Tag", True), ("DE", "2024-01-06", "x", "Tag", None), ("FR", "2020-01-01", "x", "Jour", True)])
    made = fact_upkeep.create(tx, first, none, path, "2024-06-01")
    assert made.months == ["2024-01", "2024-02", "2024-03", "2024-04"] and made.rows == 60
    before = {part.key: part.path for part in snapshots.current(spark, path).tables[fact_upkeep.FACT]}

    done = fact_upkeep.refresh(spark, path, "2024-06-02", customers=late)
    assert done.months == ["2024-02"]
    after = {part.key: part.path for part in snapshots.current(spark, path).tables[fact_upkeep.FACT]}
    assert {k for k in after if after[k] != before[k]} == {"2024-02"} and set(after) == set(before)
    assert _same(fact_upkeep.read_fact(spark, path), build_fact(tx, late, none))

    assert fact_upkeep.refresh(spark, path, "2024-06-03", holidays=days).months == ["2024-04"]
    assert _same(fact_upkeep.read_fact(spark, path), build_fact(tx, late, days))
    gone = _customers(spark, [("C5", "Spain", None, None, False)])
    done = fact_upkeep.refresh(spark, path, "2024-06-04", customers=gone, holidays=none)
    assert _same(fact_upkeep.read_fact(spark, path), build_fact(tx, gone, none)) and len(done.months) == 4
    assert fact_upkeep.refresh(spark, path, "2024-06-05", customers=gone).months == []
    assert fact_upkeep.read_fact(spark, path, 1).count() == 60


def test_no_transactions(spark, tmp_path):
    path, tx = str(tmp_path / "wh"), _transactions(spark).where("false")
    customers = _customers(spark, [("C1", "Spain", None, None, True)])
    assert fact_upkeep.create(tx, customers, _holidays(spark, []), path, "2024-06-01") == ([], 0)


# --------------------------------------------------------------------------- rollups
def test_distinct_counts_of_any_period(spark, tmp_path):
    """Codes beyond one bucket, customers that come back in later deliveries, guests, a repeated delivery."""
    path = str(tmp_path / "wh")
    fact = spark.range(0, 90_000, 1, 6).selectExpr(
        "id", "if(id % 11 = 0, null, concat('C', id % 40000)) as CustomerID", "timestamp(date_add(date'2024-01-01', cast(id % 70 as int))) as InvoiceDate",
        "cast(id % 100 as double) as LineTotal",
    )
    new = [rollups.add_rows(fact.where(F.col("id") % 3 == n), path, f"d{n}", "2024-06-01") for n in (0, 1, 1, 2)]
    everyone = fact.select("CustomerID").distinct().where("CustomerID is not null").count()
    assert sum(new) == everyone > 32_768 and new[2] == 0
    codes = snapshots.read(spark, path, rollups.CODES)
    assert sorted(r["code"] for r in codes.collect()) == list(range(everyone))
    for period in (F.date_trunc("month", "day").cast("string"), F.lit("all"), F.col("day").cast("string")):
        got = {r["period"]: tuple(r)[1:] for r in rollups.distinct_customers(spark, path, period).collect()}
        wanted = fact.withColumn("day", F.to_date("InvoiceDate")).groupBy(period.alias("period")).agg(
            F.count("*"), F.sum("LineTotal").cast("decimal(38,4)"), F.count_distinct("CustomerID"))
        assert got == {r["period"]: tuple(r)[1:] for r in wanted.collect()}
    earlier = rollups.distinct_customers(spark, path, F.lit("all"), version=1).first()
    assert earlier["tx_rows"] == 30_000


def test_rollup_without_rows_or_customers(spark, tmp_path):
    path = str(tmp_path / "wh")
    assert rollups.distinct_customers(spark, path, F.lit("all")).collect() == []
    guests = spark.range(3).selectExpr("cast(null as string) as CustomerID", "timestamp'2024-01-01' as InvoiceDate", "1.5D as LineTotal")
    assert rollups.add_rows(guests.where("false"), path, "d0", "2024-06-01") == 0
    assert rollups.add_rows(guests, path, "d1", "2024-06-01") == 0
    assert [tuple(r) for r in rollups.distinct_customers(spark, path, F.lit("all")).collect()] == [("all", 3, 4.5, 0)]
