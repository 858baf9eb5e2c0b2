"""Queries over tables that grow by deliveries: incremental keep-first and upkeep of the fact."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from veritill.catalogue import adapters, frames
from veritill.catalogue.adapters import AS_OF, plain
from veritill.catalogue.oracle import FACT_COLUMNS, with_ctes
from veritill.catalogue.registry import query
from veritill.model import CUSTOMER_KEY, ROW_ID, TRANSACTION_KEY
from veritill.operators import cleaning, deliveries, reconcile, rollups, wide_keys
from veritill.plans import fact_upkeep
from veritill.session import scratch_dir
from veritill.sources import snapshots
from veritill.sources.sinks import FACT_SLICES, in_parallel


def _delivered(spark, rows, keys, number):
    """Three deliveries one by one, the second of them sent twice; the table they leave."""
    path = scratch_dir(spark, "deliveries")
    stored = frames.stored(rows.withColumn("delivery", number), "rows")
    for n in (0, 1, 1, 2):
        deliveries.deliver(stored.where(F.col("delivery") == n), path, "kept", keys, f"day {n}", AS_OF)
    return snapshots.read(spark, path, "kept")


@query(
    "c15_deliveries",
    with_ctes(
        """SELECT "InvoiceNo", "StockCode", l_linenumber AS line, l_linenumber % 3 AS delivery FROM (
             SELECT *, ROW_NUMBER() OVER (PARTITION BY "InvoiceNo", "StockCode"
               ORDER BY l_linenumber % 3, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_discount, l_tax,
                 l_returnflag, l_linestatus) AS nth
             FROM tagged_tx WHERE "_reject_reason" = '') WHERE nth = 1""",
        "tagged_tx",
    ),
)
def c15_deliveries(spark, sf):
    """Transactions in three deliveries: the first row of each key over all of them."""
    typed = frames.typed_tx(spark, sf)
    line = F.col(f"{ROW_ID}.l_linenumber")
    accepted = typed.where(cleaning.is_accepted(AS_OF)).select(*TRANSACTION_KEY, line.alias("line"), ROW_ID)
    kept = _delivered(spark, accepted, TRANSACTION_KEY, line % 3)
    return kept.select(*TRANSACTION_KEY, "line", "delivery")


@query(
    "c23_deliveries",
    with_ctes(
        """SELECT "CustomerID", "Country", CAST(row_id % 3 AS INTEGER) AS delivery FROM (
             SELECT *, ROW_NUMBER() OVER (PARTITION BY "CustomerID" ORDER BY row_id % 3, row_id) AS nth
             FROM typed_cu WHERE "CustomerID" IS NOT NULL) WHERE nth = 1""",
        "typed_cu",
    ),
)
def c23_deliveries(spark, sf):
    """Customers in three deliveries: the first row of each id over all of them."""
    typed = cleaning.type_customers(adapters.raw_customers(spark, sf)).where(F.col("CustomerID").isNotNull())
    return _delivered(spark, typed, CUSTOMER_KEY, (F.col(ROW_ID) % 3).cast("int")).select("CustomerID", "Country", "delivery")


@query("j12_late_files", with_ctes(f"SELECT {FACT_COLUMNS} FROM fact", "fact"))
def j12_late(spark, sf):
    """A fact built from some customers and some holidays, then brought up to the whole files, which come late."""
    path = scratch_dir(spark, "upkeep")
    cu = frames.stored(frames.clean_cu(spark, sf), "customers")
    days = frames.stored(adapters.holidays(spark, sf), "holidays")
    number = F.col("CustomerID").cast("bigint")
    early = cu.where(number % 7 != 0).withColumn("Segment", F.when(number % 5 == 0, F.lit("old")).otherwise(F.col("Segment")))
    first, *others = frames.clean_slices(spark, sf)
    with frames.passing(first, "transactions", *others) as tx:
        fact_upkeep.create(tx, early, days.where(F.month("date") % 2 == 0), path, "2001-12-31 00:00:00", slices=FACT_SLICES)
    fact_upkeep.refresh(spark, path, "2001-12-31 12:00:00", customers=cu)
    # earlier versions are not asked for again; only their parts that the newest has not go
    snapshots.expire(spark, path, keep=1)
    fact_upkeep.refresh(spark, path, AS_OF, holidays=days)
    snapshots.expire(spark, path, keep=1)
    return plain(fact_upkeep.read_fact(spark, path))


_PERIODS = {
    "month": ("strftime(\"InvoiceDate\", '%Y-%m')", "TRUE"),
    "week": ("CAST(date_trunc('week', \"InvoiceDate\") AS DATE)::VARCHAR", "TRUE"),
    "1997, first half": ("'all'", "\"InvoiceDate\" >= DATE '1997-01-01' AND \"InvoiceDate\" < DATE '1997-07-01'"),
}


@query(
    "g03_customer_rollup",
    with_ctes(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS kind, {period} AS period, COUNT(*) AS tx_rows, COUNT(DISTINCT "CustomerID") AS customers
                FROM clean_tx WHERE {where} GROUP BY ALL"""
            for name, (period, where) in _PERIODS.items()
        ),
        "clean_tx",
    ),
)
def g03_rollup(spark, sf):
    """Distinct customers of months, weeks and half a year, all from the same bitmaps by day, which three deliveries left."""
    path = scratch_dir(spark, "rollup")
    tx = frames.stored(frames.clean_tx(spark, sf).select("InvoiceNo", "CustomerID", "InvoiceDate", "LineTotal"), "transactions")
    for n in (0, 1, 1, 2):
        rollups.add_rows(tx.where(F.col("InvoiceNo").cast("bigint") % 3 == n), path, f"delivery {n}", AS_OF)
    half = F.col("day").between(F.lit("1997-01-01").cast("date"), F.lit("1997-06-30").cast("date"))
    parts = [
        ("month", F.date_format("day", "yyyy-MM"), None),
        ("week", F.date_trunc("week", "day").cast("date").cast("string"), None),
        ("1997, first half", F.lit("all"), half),
    ]
    found = [
        rollups.distinct_customers(spark, path, period, where).select(F.lit(name).alias("kind"), "period", "tx_rows", "customers")
        for name, period, where in parts
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "q02_wide_keys",
    with_ctes(
        """SELECT COUNT(*) AS duplicate_keys, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows FROM (
             SELECT COUNT(*) AS n FROM raw_tx GROUP BY "StockCode", "Description", "Quantity", "Status", "Country", "PaymentMethod"
             HAVING COUNT(*) > 1)""",
        "raw_tx",
    ),
)
def q02_wide(spark, sf):
    """Duplicates of a key of six columns, by fingerprints first."""
    raw = frames.stored(adapters.raw_transactions(spark, sf).drop(ROW_ID), "raw")
    return wide_keys.surplus_of(raw, ["StockCode", "Description", "Quantity", "Status", "Country", "PaymentMethod"])


@query(
    "r17_reconciliation",
    with_ctes(
        """SELECT 'transactions_clean' AS layer, (SELECT COUNT(*) FROM clean_tx) AS expected_rows,
             (SELECT COUNT(*) FROM clean_tx) AS stored_rows, 'true' AS same_rows
           UNION ALL SELECT 'transactions_rejected', n, n, 'true' FROM (SELECT COUNT(*) AS n FROM tagged_tx WHERE "_reject_reason" <> '')
           UNION ALL SELECT 'transactions_duplicate', n - c, n - c, 'true' FROM (SELECT COUNT(*) AS n,
             (SELECT COUNT(*) FROM clean_tx) AS c FROM tagged_tx WHERE "_reject_reason" = '')
           UNION ALL SELECT 'customers_clean', n, n, 'false' FROM (SELECT COUNT(*) AS n FROM clean_cu)
           UNION ALL SELECT 'customers_rejected', n, n, 'true' FROM (SELECT COUNT(*) AS n FROM typed_cu WHERE "CustomerID" IS NULL)
           UNION ALL SELECT 'customers_duplicate', n, n, 'false' FROM (SELECT COUNT("CustomerID") - (SELECT COUNT(*) FROM clean_cu) AS n FROM typed_cu)""",
        "clean_tx",
        "clean_cu",
    ),
)
def r17_reconciliation(spark, sf):
    """Stored layers against their raw rows.  In the stored customers the segments of one country were changed: counts agree, rows do not."""
    raw_tx, raw_cu = frames.stored_raw(spark, sf)
    tx, cu = cleaning.clean_transactions(raw_tx, AS_OF), cleaning.clean_customers(raw_cu)
    odd = cu.clean.withColumn("Segment", F.when(F.col("Country") == "Germany", F.lit("other")).otherwise(F.col("Segment")))
    layers = {"clean": tx.clean, "rejected": tx.rejected, "odd": odd, "rejected-customers": cu.rejected}
    clean, rejected, odd, no_id = in_parallel(*[partial(frames.stored, df, label) for label, df in layers.items()])
    found = reconcile.reconcile(
        raw_tx, lambda raw: cleaning.clean_transactions(raw, AS_OF), clean, rejected, "transactions"
    ).unionByName(reconcile.reconcile(raw_cu, cleaning.clean_customers, odd, no_id, "customers"))
    return plain(found)
