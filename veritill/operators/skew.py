"""Left lookups that hold up when one key carries a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets a hot key is spread over, on both sides of the join.
SALTS = 64
#: A key is hot from this share of the rows on, so there are at most ``1 / HOT_SHARE`` hot keys.
HOT_SHARE = 0.002


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _bucket(columns: Sequence[str], salts: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def hot_keys(facts: DataFrame, keys: Sequence[str], hot_share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``hot_share`` of the rows: at most ``1 / hot_share`` of them."""
    counts = facts.where(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.select(F.sum("_n")).scalar()
    return counts.where(F.col("_n") > total * F.lit(hot_share)).select(*keys)


def left_lookup(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    salted: bool = False,
    salts: int = SALTS,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """``facts LEFT JOIN dim`` on equal keys; ``dim`` holds each key once, null matches nothing.

    Rows with a null key match nothing wherever they land and are spread over all partitions, should
    Spark shuffle the join; it may still broadcast a dimension within the session's threshold.  Hot keys are left to adaptive execution, which splits a skewed
    partition of the left side at run time.

    ``salted`` does not wait for that: rows of a hot key are spread over ``salts`` buckets, for
    which only that key's dimension row is repeated, so the dimension grows by at most
    ``salts / hot_share`` rows.  Finding the hot keys reads the key columns of ``facts`` once
    more, so pass a stored table.
    """
    keys = list(keys)
    no_key = _any_null(keys)
    if not salted:
        spread = facts.withColumn("_salt", F.when(no_key, _bucket(facts.columns, salts)).otherwise(F.lit(0)))
        return spread.join(dim.withColumn("_salt", F.lit(0)), [*keys, "_salt"], "left").drop("_salt")

    hot = F.broadcast(hot_keys(facts, keys, hot_share).withColumn("_hot", F.lit(True)))
    is_hot = F.col("_hot").isNotNull()
    salted_facts = facts.join(hot, keys, "left").withColumn(
        "_salt", F.when(is_hot | no_key, _bucket(facts.columns, salts)).otherwise(F.lit(0))
    )
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_dim = dim.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0))))
    )
    joined = salted_facts.drop("_hot").join(salted_dim.drop("_hot"), [*keys, "_salt"], "left")
    return joined.drop("_salt")
