"""Reconciliation by content (R17, C25): the rows of a stored layer are those that its raw rows give, not just as many.

A layer's digest does not depend on the order of its rows: their number and two sums of 64-bit hashes,
taken modulo 2^64.  One row changed, lost, added or taken twice changes it, also where counts agree.
The raw layer is cleaned again and digested side by side with what was stored, so that

    raw = clean + rejected + duplicates

holds for the rows: clean and rejected are compared by digest, and duplicates are what is left of raw.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sums of hashes are taken modulo this.
MODULUS = 1 << 64
#: The 22 lowest bits of a long.
LOW_BITS = (1 << 22) - 1


def _sum_of(h: Column) -> Column:
    """Sum of 64-bit hashes modulo 2^64, from long sums of three parts: a wide decimal per row takes far longer.

    Parts have 22 bits at most, so their sums fit up to 2^41 rows.
    """
    wide, total = "decimal(38,0)", F.lit(0).cast("decimal(38,0)")
    for place in (44, 22, 0):
        part = F.shiftright(h, place) if place == 44 else F.shiftright(h, place).bitwiseAND(F.lit(LOW_BITS))
        total = total + F.coalesce(F.sum(part), F.lit(0)).cast(wide) * F.lit(str(1 << place)).cast(wide)
    return F.pmod(total, F.lit(str(MODULUS)).cast(wide)).cast("string")


def digest(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: ``row_count`` and ``digest`` of the rows as a multiset; a null differs from every value."""
    names = sorted(columns or df.columns)
    values = [F.col(f"`{c}`") for c in names]
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    first, second = F.xxhash64(*values, nulls), F.xxhash64(nulls, *values[::-1], F.lit("second"))
    found = df.agg(F.count(F.lit(1)).alias("row_count"), _sum_of(first).alias("a"), _sum_of(second).alias("b"))
    return found.select("row_count", F.concat_ws("-", "a", "b").alias("digest"))


def compare(expected: DataFrame, stored: DataFrame, layer: str) -> DataFrame:
    """One row: what a layer should hold, what it holds, and whether these are the same rows."""
    columns = sorted(set(expected.columns) & set(stored.columns))
    lost = sorted(set(expected.columns) ^ set(stored.columns))
    left = digest(expected, columns).toDF("expected_rows", "expected_digest")
    right = digest(stored, columns).toDF("stored_rows", "stored_digest")
    same = (F.col("expected_digest") == F.col("stored_digest")) & (F.col("expected_rows") == F.col("stored_rows"))
    # both sides have exactly one row
    joined = left.withColumn("one", F.lit(1)).join(right.withColumn("one", F.lit(1)), "one")
    return joined.select(
        F.lit(layer).alias("layer"), "expected_rows", "stored_rows", (same & F.lit(not lost)).alias("same_rows"), "expected_digest", "stored_digest"
    )


def reconcile(raw: DataFrame, clean_again, clean: DataFrame, rejected: DataFrame, name: str) -> DataFrame:
    """Rows of the audit for one source: clean, rejected, and the duplicates that make up the rest of raw.

    ``clean_again`` is the cleaner of the source; pass stored layers.
    """
    split = clean_again(raw)
    found = compare(split.clean, clean, f"{name}_clean").unionByName(compare(split.rejected, rejected, f"{name}_rejected"))
    counts = raw.agg(F.count(F.lit(1)).alias("n"))
    rest = found.agg(F.sum("expected_rows").alias("expected"), F.sum("stored_rows").alias("stored"), F.bool_and("same_rows").alias("same"))
    duplicates = rest.select(
        F.lit(f"{name}_duplicate").alias("layer"), (counts.scalar() - F.col("expected")).alias("expected_rows"),
        (counts.scalar() - F.col("stored")).alias("stored_rows"),
        (F.col("same") & (counts.scalar() >= F.col("stored"))).alias("same_rows"),
    )
    return found.drop("expected_digest", "stored_digest").unionByName(duplicates)
