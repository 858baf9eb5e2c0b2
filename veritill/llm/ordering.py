"""The next row in the order of an id, without one task that sorts everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritill.llm.common import shuffle_partitions

MOST_BOUNDS = 255


def _bucket(value: Column, bounds: list[int], parts: int) -> Column:
    """Bucket of an id: a binary decision over the bounds, then equal steps between two bounds."""

    def within(low: int, high: int, number: int) -> Column:
        if parts == 1:
            return F.lit(number)
        step = max(1, -(-(high - low) // parts))
        return F.lit(number * parts) + F.least(F.lit(parts - 1), F.floor((value - F.lit(low)) / F.lit(step))).cast("int")

    def split(first: int, last: int) -> Column:
        if first == last:
            low, high = bounds[first], bounds[first + 1] if first + 1 < len(bounds) else bounds[first] + 1
            return within(low, high, first)
        middle = (first + last + 1) // 2
        return F.when(value < F.lit(bounds[middle]), split(first, middle - 1)).otherwise(split(middle, last))

    return split(0, len(bounds) - 1)


def in_order(df: DataFrame, order: str, tie: str) -> tuple[DataFrame, Column]:
    """Rows dealt to buckets of neighbouring ids, each with its successor's first row behind its own.

    Returns the rows, with ``bucket`` and ``sentinel`` (true for the repeated first rows, which are to be
    dropped after use), and the window in which ``lead`` finds the next row; the last row of all is
    followed by the first.  Rows without id come first; ties go by ``tie``.
    """
    spark = df.sparkSession
    buckets = 4 * shuffle_partitions(df)
    n_bounds = min(MOST_BOUNDS, buckets)
    marks = df.agg(
        F.percentile_approx(order, [i / n_bounds for i in range(n_bounds + 1)], 10_000).alias("marks")
    ).first()["marks"]
    bounds = sorted(set(marks or [0]))
    bucket = F.coalesce(_bucket(F.col(order), bounds, -(-buckets // n_bounds)), F.lit(0)).cast("int")
    rows = df.withColumn("bucket", bucket)
    # at most one row per bucket, and their number is set by the cluster, not by the data
    firsts = sorted(
        (r["bucket"], r["first"][order], r["first"][tie])
        for r in rows.select("bucket", order, tie).groupBy("bucket").agg(F.min(F.struct(order, tie)).alias("first")).collect()
    ) if marks else []
    if not firsts:
        firsts = [(r["bucket"], r[order], r[tie]) for r in rows.select("bucket", order, tie).limit(1).collect()]
    targets = [(firsts[i - 1][0], f[1], f[2]) for i, f in enumerate(firsts)]
    keys = spark.createDataFrame(targets, f"target int, first_id {dict(df.dtypes)[order]}, first_tie {dict(df.dtypes)[tie]}")
    copies = rows.join(
        F.broadcast(keys), F.col(order).eqNullSafe(F.col("first_id")) & F.col(tie).eqNullSafe(F.col("first_tie"))
    ).withColumn("bucket", F.col("target")).drop("target", "first_id", "first_tie")
    both = rows.withColumn("sentinel", F.lit(False)).unionByName(copies.withColumn("sentinel", F.lit(True)))
    window = Window.partitionBy("bucket").orderBy("sentinel", F.col(order).asc_nulls_first(), tie)
    return both.repartition(shuffle_partitions(df), "bucket"), window
