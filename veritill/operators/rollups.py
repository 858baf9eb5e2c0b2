"""Exact distinct counts that roll up (G3, R1, Q18): customers of any days, weeks or months without their rows.

Every customer gets a dense code once; codes are kept in the warehouse.  A delivery of rows leaves one
bitmap of codes per day and bucket of 32,768 codes.  Bitmaps of a day may come from several deliveries:
they are joined by OR, as are those of the days of any period, so a distinct count of a period is a
count of bits, and no row is read again.  Rows and revenue are kept beside them and add up.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritill.functions import at_scale
from veritill.session import scratch_dir
from veritill.sources import sinks, snapshots

CODES, DAYS, SUMS = "customer_codes", "customer_days", "day_sums"
_CODE_SCHEMA = "CustomerID string, code bigint"
_DAY_SCHEMA = "day date, bucket bigint, bitmap binary"
_SUM_SCHEMA = "day date, n bigint, revenue decimal(38,4)"
_LOCAL = (1 << 33) - 1
_TRIES = 20


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _read(spark: SparkSession, warehouse: str, table: str, version: int | None, schema: str) -> DataFrame:
    empty = spark.createDataFrame([], schema)
    held = snapshots.current(spark, warehouse, version).tables.get(table)
    return snapshots.read(spark, warehouse, table, version, schema=empty.schema) if held else empty


def numbered(ids: DataFrame, first: int) -> DataFrame:
    """Dense codes from ``first`` on for distinct ids: a row's place in its partition behind the partitions before.

    Ids are stored with their places, so that a lost executor cannot number them anew.
    """
    spark = ids.sparkSession
    placed = _stored(ids.withColumn("place", F.monotonically_increasing_id()), "codes")
    part = F.shiftright("place", 33)
    before, starts = first, []
    # one row per partition
    for row in sorted(placed.groupBy(part.alias("part")).count().collect(), key=lambda r: r["part"]):
        starts.append((row["part"], before))
        before += row["count"]
    offsets = spark.createDataFrame(starts, "part bigint, start bigint")
    joined = placed.join(F.broadcast(offsets), part == F.col("part"))
    return joined.select("CustomerID", (F.col("start") + F.col("place").bitwiseAND(F.lit(_LOCAL))).alias("code"))


def add_rows(fact: DataFrame, warehouse: str, delivery: str, published_at: str | datetime) -> int:
    """Add the rows of a delivery to the counts; one that is there already changes nothing.  Returns its new customers."""
    spark = fact.sparkSession
    for _ in range(_TRIES):
        version = snapshots.current(spark, warehouse)
        if delivery in {part.key for part in version.tables.get(SUMS, [])}:
            return 0
        try:
            return _add_rows(fact, warehouse, delivery, published_at, version)
        except snapshots.Conflict:
            continue  # codes were given out meanwhile
    raise snapshots.Conflict(f"{warehouse} changes too often")


def _add_rows(fact, warehouse, delivery, published_at, version) -> int:
    spark, day = fact.sparkSession, F.to_date("InvoiceDate").alias("day")
    # one row per customer and day, so hot customers collapse before the join
    seen = _stored(fact.where(F.col("CustomerID").isNotNull()).select("CustomerID", day).distinct(), "customer-days")
    codes = _read(spark, warehouse, CODES, version.number, _CODE_SCHEMA)
    given = sum(part.rows for part in version.tables.get(CODES, []))
    fresh = numbered(seen.select("CustomerID").distinct().join(codes, "CustomerID", "left_anti"), given)
    new = sinks._stage(fresh, warehouse, CODES, delivery)
    everyone = codes.unionByName(spark.read.schema(_CODE_SCHEMA).parquet(f"{warehouse}/{CODES}/{new.path}"))

    # codes are numbered from 0, bits from 1
    code = F.col("code") + 1
    bits = seen.join(everyone, "CustomerID").select(
        "day", F.bitmap_bucket_number(code).alias("bucket"), F.bitmap_bit_position(code).alias("bit")
    )
    days = bits.groupBy("day", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    sums = fact.groupBy(day).agg(F.count(F.lit(1)).alias("n"), F.sum(at_scale(F.col("LineTotal"), 28, 4)).cast("decimal(38,4)").alias("revenue"))
    changes = {
        CODES: snapshots.Change("append", (new,)),
        DAYS: snapshots.Change("append", (sinks._stage(days, warehouse, DAYS, delivery),)),
        SUMS: snapshots.Change("append", (sinks._stage(sums, warehouse, SUMS, delivery),)),
    }
    snapshots.publish(spark, warehouse, changes, published_at, based_on=version)
    return new.rows


def distinct_customers(
    spark: SparkSession, warehouse: str, period: Column, where: Column | None = None, version: int | None = None
) -> DataFrame:
    """Rows, revenue and distinct customers by ``period``, an expression over ``day``; ``where`` restricts the days.

    Reads a bitmap for each day and bucket, and no transactions.
    """
    days, sums = _read(spark, warehouse, DAYS, version, _DAY_SCHEMA), _read(spark, warehouse, SUMS, version, _SUM_SCHEMA)
    if where is not None:
        days, sums = days.where(where), sums.where(where)
    per_bucket = days.groupBy(period.alias("period"), "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("customers"))
    customers = per_bucket.groupBy("period").agg(F.sum("customers").alias("customers"))
    totals = sums.groupBy(period.alias("period")).agg(F.sum("n").alias("tx_rows"), F.sum("revenue").alias("revenue"))
    own = customers.withColumnRenamed("period", "own")
    joined = totals.join(own, F.col("period").eqNullSafe(F.col("own")), "left")
    return joined.select("period", "tx_rows", "revenue", F.coalesce("customers", F.lit(0)).alias("customers"))
