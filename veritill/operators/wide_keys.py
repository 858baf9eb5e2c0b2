"""Duplicates of wide keys (V4, Q1, Q2, R12): only rows whose fingerprint recurs are shuffled with their key.

Grouping by a wide key sends every key through the shuffle, though most occur once.  A first pass groups
64-bit fingerprints and keeps those that recur; a second pass groups the keys of those rows alone.
Equal keys have equal fingerprints, so nothing is missed, and keys that merely share a fingerprint are
told apart in the second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritill.session import scratch_dir


def fingerprint(keys: Sequence[str]) -> Column:
    """Of all parts of a key and of which of them are null."""
    nulls = F.concat(*[F.when(F.col(f"`{k}`").isNull(), "1").otherwise("0") for k in keys])
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys], nulls)


def recurring(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fingerprints of more than one row, stored; eight bytes a row are shuffled."""
    folder = scratch_dir(df.sparkSession, "fingerprints")
    counted = df.select(fingerprint(keys).alias("mark")).groupBy("mark").agg(F.count(F.lit(1)).alias("n"))
    counted.where(F.col("n") > 1).select("mark").write.parquet(folder)
    return df.sparkSession.read.schema("mark bigint").parquet(folder)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of more than one row and their ``row_count``; nulls equal each other in every part."""
    rows = df.select(*[F.col(f"`{k}`") for k in keys], fingerprint(keys).alias("mark"))
    # where the fingerprints that recur are few, Spark sends them to the tasks and no row moves before it is
    # grouped; where they are many, a hot fingerprint is split by the skewed join
    marked = rows.join(recurring(df, keys), "mark", "left_semi")
    return marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def surplus_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows beyond the first of each key, and how many keys have such."""
    found = duplicate_keys(df, keys)
    return found.agg(
        F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("surplus_rows")
    )
