"""Keep-first over many deliveries (C15, C23) with a persistent index of the keys that are known.

A delivery is de-duplicated by itself, then against all keys of earlier ones.  Known keys lie in the
warehouse by hash: every part of the index is split into ``SLOTS`` folders by the top bits of the
key's hash, and into finer ranges of about ``RANGE_KEYS`` keys, each with a Bloom filter (a bitmap of
32,768 bits, four of them set per key).  New keys are first held against the filters; only the
folders of keys that may be known are opened, and there the keys themselves are compared, so a
filter never decides that a row is a duplicate.  When ``MOST_PARTS`` parts have come together they are
merged into one, so a key is held against few filters however many deliveries there were.

Rows, keys and filters of a delivery are published as one version of the warehouse.  A delivery that is
repeated changes nothing; two at the same time are put one after the other, the later one anew.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritill.operators.cleaning import keep_first
from veritill.session import scratch_dir
from veritill.sources import sinks, snapshots

SLOT_BITS, RANGE_KEYS, MOST_PARTS = 6, 2500, 8
SLOTS = 1 << SLOT_BITS
#: Bits of a filter, as the bitmap functions of Spark lay them out, and how many of them a key sets.
FILTER_BITS, PROBES = 32_768, 4
_TRIES = 20


class Delivered(NamedTuple):
    #: Rows with new keys.
    new: int
    #: Rows whose key an earlier row of this delivery, or an earlier delivery, has.
    known: int


def _bits(h: Column) -> list[Column]:
    """Places of a key in the filter of its range, by two more hashes."""
    first, step = F.xxhash64(h, F.lit(1)), F.xxhash64(h, F.lit(2)).bitwiseOR(F.lit(1))
    return [F.pmod(F.shiftright(first, 17) + i * F.shiftright(step, 17), F.lit(FILTER_BITS)).cast("int") for i in range(PROBES)]


def _range(bits: str) -> Column:
    return F.expr(f"shiftrightunsigned(key_hash, 64 - {bits})")


def _hashed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    names = [F.col(f"`{k}`") for k in keys]
    return rows.select(F.xxhash64(*names).alias("key_hash"), *names)


def _filters(index: DataFrame, part: str, n: int) -> DataFrame:
    """One filter per range of a part; the ranges are as many as its keys need."""
    bits = max(SLOT_BITS, math.ceil(math.log2(max(1, n) / RANGE_KEYS)))
    places = index.select(_range(str(bits)).alias("range"), F.explode(F.array(*_bits(F.col("key_hash")))).alias("bit"))
    return places.groupBy("range").agg(F.bitmap_construct_agg("bit").alias("filter")).select(
        F.lit(part).alias("part"), F.lit(bits).alias("bits"), "range", "filter"
    )


def _is_set(bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col("filter"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), bit % 8)).cast("int") % 2 == 1


def _equal(keys: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in keys])


def possibly_known(hashed: DataFrame, filters: DataFrame) -> DataFrame:
    """Keys that a filter lets pass, with the part and the slot in which they may be."""
    # a handful of range sizes, as they are powers of two
    sizes = [row["bits"] for row in filters.select("bits").distinct().collect()]
    if not sizes:
        return hashed.select("*", F.lit("").alias("part"), F.lit(0).alias("slot")).where("false")
    probes = hashed.withColumn("bits", F.explode(F.array(*[F.lit(size) for size in sizes]))).withColumn("range", _range("bits"))
    passed = reduce(lambda a, b: a & b, [_is_set(bit) for bit in _bits(F.col("key_hash"))])
    found = probes.join(filters, ["bits", "range"]).where(passed)
    return found.select(*hashed.columns, "part", _range(str(SLOT_BITS)).cast("int").alias("slot"))


def known_keys(spark: SparkSession, hashed: DataFrame, keys: Sequence[str], warehouse: str, index: str, version: snapshots.Version) -> DataFrame | None:
    """The keys that earlier deliveries have: filters first, then the keys in the folders that may hold them; None without any."""
    if not version.tables.get(index):
        return None
    filters = snapshots.read(spark, warehouse, f"{index}_filters", version.number)
    folder = scratch_dir(spark, "possibly-known")
    possibly_known(hashed, filters).write.parquet(folder)
    possible = spark.read.parquet(folder)
    # at most MOST_PARTS x SLOTS rows
    opened = [f"{warehouse}/{index}/{row['part']}/slot={row['slot']}" for row in possible.select("part", "slot").distinct().collect()]
    if not opened:
        return None
    there = spark.read.schema(hashed.schema).parquet(*opened)
    on = (possible["key_hash"] == there["key_hash"]) & _equal(keys, possible, there)
    return possible.join(there, on, "left_semi").select(*hashed.columns)


def deliver(
    df: DataFrame,
    warehouse: str,
    table: str,
    keys: Sequence[str],
    delivery: str,
    delivered_at: str | datetime,
    order_by: Sequence[str | Column] | None = None,
) -> Delivered:
    """Add the rows of a delivery whose keys are new, the first of each key; a delivery that is there already is left alone.

    Pass a stored layer: its keys, its rows and their number are read on their own.
    """
    for _ in range(_TRIES):
        version = snapshots.current(df.sparkSession, warehouse)
        if delivery in {part.key for part in version.tables.get(table, [])}:
            return Delivered(0, 0)
        try:
            return _deliver(df, warehouse, table, keys, delivery, delivered_at, order_by, version)
        except snapshots.Conflict:
            continue  # another delivery was published meanwhile; its keys count as well
    raise snapshots.Conflict(f"{warehouse} changes too often")


def _deliver(df, warehouse, table, keys, delivery, delivered_at, order_by, version) -> Delivered:
    spark, index = df.sparkSession, f"{table}_keys"
    first = keep_first(df, keys, order_by)
    hashed = _hashed(df, keys).distinct()
    known = known_keys(spark, hashed, keys, warehouse, index, version)
    fresh_rows = first if known is None else first.join(known, _equal(keys, first, known), "left_anti")
    rows = sinks._stage(fresh_rows, warehouse, table, delivery)
    new = spark.read.schema(first.schema).parquet(f"{warehouse}/{table}/{rows.path}")

    parts = version.tables.get(index, [])
    merged = len(parts) + 1 >= MOST_PARTS
    fresh = _hashed(new, keys)
    if merged:
        held = [spark.read.schema(fresh.schema).parquet(f"{warehouse}/{index}/{part.path}").select(*fresh.columns) for part in parts]
        fresh = reduce(DataFrame.unionByName, held, fresh)
    added = _stage_index(fresh, warehouse, index)
    stored = spark.read.schema(fresh.schema).parquet(f"{warehouse}/{index}/{added.path}")
    filters = sinks._stage(_filters(stored, added.path, added.rows), warehouse, f"{index}_filters")
    operation = "replace" if merged else "append"
    changes = {
        table: snapshots.Change("append", (rows,)),
        index: snapshots.Change(operation, (added,)),
        f"{index}_filters": snapshots.Change(operation, (filters,)),
    }
    snapshots.publish(spark, warehouse, changes, delivered_at, based_on=version)
    return Delivered(rows.rows, df.count() - rows.rows)


def _stage_index(fresh: DataFrame, warehouse: str, index: str) -> snapshots.Part:
    path = snapshots.new_part(warehouse, index)
    slotted = fresh.withColumn("slot", _range(str(SLOT_BITS)).cast("int"))
    rows = sinks._write(slotted.hint("rebalance", "slot"), path, "errorifexists", ("slot",))
    return snapshots.Part(path.rsplit("/", 1)[1], rows, slotted.schema.json())
