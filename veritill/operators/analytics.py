"""Reporting aggregates over raw rows, the fact table and the run's results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veritill.functions import as_timestamp, at_scale, number, rate
from veritill.model import HOUR_BINS, ROW_ID, WEEKDAYS
from veritill.operators.anomalies import daily_counts
from veritill.operators.checks import surplus_rows
from veritill.operators.quantiles import exact_quantiles, quantile_values, sketched
from veritill.session import scratch_dir

def _rows() -> Column:
    return F.count(F.lit(1))


def _money(column: str = "LineTotal") -> Column:
    return at_scale(F.col(column), 28, 4)


def _mean(total: Column, n: Column, digits: int) -> Column:
    return F.round(total / F.nullif(n, F.lit(0)), digits)


# --------------------------------------------------------------------------- headline figures
def kpis(fact: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """One row of headline figures; guests are rows without a known customer.

    One pass: rows are summed up per customer and country, and these groups are stored; both distinct
    counts are plain ones over them, so no row is copied for a second count.  ``rejected`` adds the
    number of rejected rows.
    """
    groups = fact.groupBy("CustomerID", "Country").agg(
        _rows().alias("n"),
        F.sum(_money()).alias("revenue"),
        F.count("LineTotal").alias("orders"),
        F.count_if(F.col("Status") == "cancelled").alias("cancelled"),
        F.count_if(~F.col("is_known_customer")).alias("guests"),
        F.min("InvoiceDate").alias("first"),
        F.max("InvoiceDate").alias("last"),
    )
    folder = scratch_dir(fact.sparkSession, "customer-countries")
    groups.write.parquet(folder)
    stored = fact.sparkSession.read.schema(groups.schema).parquet(folder)
    sums = [F.sum(c).alias(c) for c in ("n", "revenue", "orders", "cancelled", "guests")]
    per_customer = stored.groupBy("CustomerID").agg(*sums, F.min("first").alias("first"), F.max("last").alias("last"))
    countries = stored.select("Country").distinct().agg(F.count("Country").alias("countries"))
    n = F.coalesce(F.sum("n"), F.lit(0))
    figures = per_customer.agg(
        n.alias("tx_rows"),
        F.round(F.sum("revenue"), 2).alias("total_revenue"),
        F.count("CustomerID").alias("unique_customers"),
        _mean(F.sum("revenue"), F.sum("orders"), 2).alias("avg_order_value"),
        F.bround(rate(F.coalesce(F.sum("cancelled"), F.lit(0)), n) * 100, 1).alias("cancel_pct"),
        F.min("first").alias("date_min"),
        F.max("last").alias("date_max"),
        F.bround(rate(F.coalesce(F.sum("guests"), F.lit(0)), n) * 100, 1).alias("guest_pct"),
    )
    names = ["tx_rows", "total_revenue", "unique_customers", "avg_order_value", "cancel_pct", "countries"]
    names += ["date_min", "date_max", "guest_pct"]
    found = figures.select("*", countries.scalar().alias("countries")).select(*names)
    if rejected is None:
        return found
    return found.select("*", rejected.agg(_rows()).scalar().alias("rejected_rows"))


def daily_volume(fact: DataFrame) -> DataFrame:
    """R2: rows per day with the centred seven-day mean."""
    frame = Window.orderBy("day").rowsBetween(-3, 3)
    return daily_counts(fact).select("day", "tx_count", F.avg("tx_count").over(frame).alias("rolling7"))


def top_countries_by_revenue(fact: DataFrame, top: int = 10) -> DataFrame:
    """R3."""
    return (
        fact.where(F.col("Country").isNotNull())
        .groupBy("Country")
        .agg(F.sum(_money()).alias("revenue"))
        .orderBy(F.desc("revenue"), "Country")
        .limit(top)
    )


def status_distribution(fact: DataFrame) -> DataFrame:
    """Rows and percent per status, null left out."""
    counted = fact.where(F.col("Status").isNotNull()).groupBy("Status").agg(_rows().alias("row_count"))
    share = F.lit(100.0) * F.col("row_count") / F.sum("row_count").over(Window.partitionBy())
    return counted.select("Status", "row_count", share.alias("pct")).orderBy(F.desc("row_count"), "Status")


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """Revenue per calendar month."""
    return (
        fact.groupBy(F.trunc("InvoiceDate", "MM").alias("month"))
        .agg(F.sum(_money()).alias("revenue"))
        .orderBy("month")
    )


def segment_revenue(fact: DataFrame) -> DataFrame:
    """Revenue, rows and mean per known segment."""
    return (
        fact.where(F.col("CustomerSegment").isNotNull())
        .groupBy("CustomerSegment")
        .agg(
            F.sum(_money()).alias("total_revenue"),
            F.count("LineTotal").alias("tx_count"),
            _mean(F.sum(_money()), F.count("LineTotal"), 2).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), "CustomerSegment")
    )


def weekday_hours(df: DataFrame, date_col: str = "InvoiceDate") -> DataFrame:
    """Rows per weekday and two-hour bin; weekdays Monday first, empty bins zero."""
    date = F.col(date_col)
    two_hours = F.format_string("%02d:00", (F.floor(F.hour(date) / 2) * 2).cast("int"))
    placed = df.where(date.isNotNull()).select((F.weekday(date) + 1).alias("weekday"), two_hours.alias("hour_bin"))
    grid = placed.groupBy("weekday").pivot("hour_bin", list(HOUR_BINS)).count().na.fill(0)
    names = F.array(*[F.lit(d) for d in WEEKDAYS])
    return grid.select("weekday", names[F.col("weekday") - 1].alias("dow"), *HOUR_BINS).orderBy("weekday")


# --------------------------------------------------------------------------- histograms
def histogram(df: DataFrame, value: Column, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """Equal-width bins over the range of the (clipped) finite values, empty bins included.

    The last bin is closed on both sides; a constant column gets a range of width one.  The input is
    scanned once; its one column is stored for the range and the counts.
    """
    x = value.cast("double")
    if low is not None:
        x = F.greatest(x, F.lit(float(low)))
    if high is not None:
        x = F.least(x, F.lit(float(high)))
    finite = value.isNotNull() & ~F.isnan(value.cast("double")) & (F.abs(value.cast("double")) < float("inf"))
    folder = scratch_dir(df.sparkSession, "histogram")
    df.select(F.when(finite, x).alias("x")).where(F.col("x").isNotNull()).write.parquet(folder)
    xs = df.sparkSession.read.schema("x double").parquet(folder)

    flat = F.min("x") == F.max("x")
    ends = F.struct(
        F.when(flat, F.min("x") - 0.5).otherwise(F.min("x")).alias("low"),
        F.when(flat, F.max("x") + 0.5).otherwise(F.max("x")).alias("high"),
    )
    reach = xs.agg(ends.alias("r"))
    place = F.expr(f"cast(floor((x - r.low) / ((r.high - r.low) / {bins})) as int)")
    counted = (
        xs.select("x", reach.scalar().alias("r"))
        .groupBy(F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(_rows().alias("row_count"))
    )

    width = (F.col("r.high") - F.col("r.low")) / bins
    grid = (
        reach.where(F.col("r.low").isNotNull())
        .select("r", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .select(
            "bin",
            (F.col("r.low") + width * F.col("bin")).alias("bin_low"),
            (F.col("r.low") + width * (F.col("bin") + 1)).alias("bin_high"),
        )
    )
    return grid.join(counted, "bin", "left").na.fill(0, ["row_count"])


def price_histogram(fact: DataFrame, bins: int = 60) -> DataFrame:
    """Positive prices in equal-width bins."""
    return histogram(fact.where(F.col("UnitPrice") > 0), F.col("UnitPrice"), bins)


def price_median(fact: DataFrame) -> DataFrame:
    """Exact median of the positive prices."""
    positive = fact.where(F.col("UnitPrice") > 0).select("UnitPrice")
    return exact_quantiles(positive, ["UnitPrice"], [0.5]).select(F.col("value").alias("median_price"))


def quantity_histograms(fact: DataFrame) -> DataFrame:
    """Quantities clipped to [-50, 100]; 40 bins of purchases, 20 of returns."""
    quantity = F.col("Quantity")
    bought = histogram(fact.where(quantity >= 0), quantity, 40, -50, 100)
    returned = histogram(fact.where(quantity < 0), quantity, 20, -50, 100)
    return bought.withColumn("kind", F.lit("purchase")).unionByName(
        returned.withColumn("kind", F.lit("return"))
    )


def clipped_histograms(typed: DataFrame, bins: int = 50) -> DataFrame:
    """Raw prices clipped to [0, 20] and quantities to [-20, 50]."""
    price = histogram(typed, F.col("UnitPrice"), bins, 0, 20)
    quantity = histogram(typed, F.col("Quantity"), bins, -20, 50)
    return price.withColumn("column", F.lit("UnitPrice")).unionByName(
        quantity.withColumn("column", F.lit("Quantity"))
    )


# --------------------------------------------------------------------------- profiles
def check_summary(results: DataFrame) -> DataFrame:
    """Results per stage and status."""
    return results.groupBy("stage", "status").agg(_rows().alias("checks")).orderBy("stage", "status")


def null_profile(df: DataFrame, top: int | None = 15) -> DataFrame:
    """Columns with nulls by null rate; one aggregation over all columns."""
    columns = df.columns
    shares = df.agg(*[rate(F.count_if(F.col(f"`{c}`").isNull()), _rows()).alias(c) for c in columns])
    profile = shares.unpivot([], [F.col(f"`{c}`") for c in columns], "column", "null_rate")
    ranked = profile.where(F.col("null_rate") > 0).orderBy(F.desc("null_rate"), "column")
    return ranked if top is None else ranked.limit(top)


def duplicate_profile(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Surplus rows per key."""
    tx = surplus_rows(transactions, [("InvoiceNo", "StockCode"), ("InvoiceNo",)])
    tx_rows = tx.select(
        F.inline(
            F.array(
                F.struct(F.lit("InvoiceNo").alias("key"), F.col("surplus_1").alias("surplus")),
                F.struct(F.lit("InvoiceNo+StockCode").alias("key"), F.col("surplus_0").alias("surplus")),
            )
        )
    )
    cu = surplus_rows(customers, [("CustomerID",)])
    return tx_rows.unionByName(cu.select(F.lit("CustomerID").alias("key"), F.col("surplus_0").alias("surplus")))


def describe(df: DataFrame, columns: Sequence[str] = ("UnitPrice", "Quantity")) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum, to two places."""
    columns, digits = list(columns), "mean double, std double, p25 double, p50 double, p75 double, min double, max double"
    sketches = sketched(df, columns, list(_QUARTILES.values()), {"mean": F.avg, "std": F.stddev_samp})
    values = quantile_values(df, list(_QUARTILES.values()), {c: s for c, s in sketches.items() if s.n})
    rows = [
        (c, s.n, s.others["mean"], s.others["std"], *[values.get((c, q)) for q in _QUARTILES.values()], s.low, s.high)
        for c, s in sketches.items()
    ]
    found = df.sparkSession.createDataFrame(rows, f"column string, row_count bigint, {digits}")
    names = ("mean", "std", "min", "p25", "p50", "p75", "max")
    return found.select("column", "row_count", *[F.round(n, 2).alias(n) for n in names])


_QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def top_countries_by_count(df: DataFrame, top: int = 10) -> DataFrame:
    """R15."""
    return (
        df.where(F.col("Country").isNotNull())
        .groupBy("Country")
        .agg(_rows().alias("row_count"))
        .orderBy(F.desc("row_count"), "Country")
        .limit(top)
    )


def date_coverage(typed: DataFrame, as_of) -> DataFrame:
    """Range, future and unreadable dates."""
    date = F.col("InvoiceDate")
    return typed.agg(
        F.min(date).alias("date_min"),
        F.max(date).alias("date_max"),
        F.count_if(date > as_timestamp(as_of)).alias("future_dates"),
        F.count_if(date.isNull()).alias("null_dates"),
    )


def holiday_count(fact: DataFrame) -> DataFrame:
    """R18."""
    return fact.agg(F.count_if("is_holiday").alias("holiday_rows"))


def schema_preview(df: DataFrame) -> DataFrame:
    """Type and non-null rows of every column."""
    columns = df.columns
    types = dict(df.dtypes)
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("dtype"),
            F.col(f"c{i}").alias("non_null"),
            F.col("n").alias("row_count"),
        )
        for i, c in enumerate(columns)
    ]
    counted = df.agg(_rows().alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
    return counted.select(F.inline(F.array(*rows)))


def first_rows(df: DataFrame, n: int = 3) -> DataFrame:
    """The first rows in the order of the export."""
    return df.orderBy(ROW_ID).limit(n).drop(ROW_ID)


# --------------------------------------------------------------------------- layers
def layer_audit(counters: DataFrame, customer_counts: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows per layer, from the cleaning counters and one pass over the fact table."""
    tx = counters.select(F.inline(_layers("transactions"))).unionByName(
        customer_counts.select(F.inline(_layers("customers")))
    )
    facts = fact.agg(_rows().alias("n"), F.count_if(~F.col("is_known_customer")).alias("orphans")).select(
        F.inline(
            F.array(
                _layer("fact", "rows", F.col("n")),
                _layer("fact", "columns", F.lit(len(fact.columns))),
                _layer("fact", "orphans", F.col("orphans")),
            )
        )
    )
    return tx.unionByName(facts)


def _layer(layer: str, measure: str, value: Column) -> Column:
    return F.struct(
        F.lit(layer).alias("layer"), F.lit(measure).alias("measure"), value.cast("long").alias("row_count")
    )


def _layers(layer: str) -> Column:
    names = ("raw", "clean", "rejected", "duplicate")
    return F.array(*[_layer(layer, name, F.col(f"{name}_rows")) for name in names])
