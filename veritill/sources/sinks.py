"""Sinks: dated raw landing, manifest, layers, warehouse loads and the result history (K1-K9).

Row counts come from an ``Observation`` on the write itself, so counting costs no extra scan.
The observed node always sits directly below the write: tasks of that last stage report once,
even when an executor is lost and earlier stages run again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import partial, reduce
from operator import or_
from typing import NamedTuple, TypeVar

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritill.functions import as_timestamp
from veritill.model import LOADED_AT, TABLE_SCHEMAS
from veritill.sources import snapshots


T_ = TypeVar("T_")
#: Stored rows take about a third less room than under Spark's own codec.
CODEC = "zstd"
#: Slices of a fact table that are gathered one after the other.
FACT_SLICES = 6


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _write(df: DataFrame, path: str, mode: str, partition_by: tuple[str, ...] = (), dynamic: bool = True) -> int:
    counted, seen = _counted(df)
    writer: DataFrameWriter = counted.write.mode(mode).option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite" and dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return int(seen.get["rows"])


def land_raw(df: DataFrame, path: str, run_date: str, overwrite: bool = True) -> int:
    """K1: raw rows under ``run_date=<day>``; other days are never touched.

    A second landing of the same day replaces that day, or fails with ``overwrite=False``.  A
    delivery without rows leaves an empty table with its columns.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    return _write(df.drop("run_date"), f"{path}/run_date={run_date}", mode)


def write_manifest(
    spark: SparkSession, path: str, run_date: str, counts: Mapping[str, int], ingested_at: str | datetime
) -> None:
    """K2: one JSON document per run with the rows of every source."""
    manifest = spark.range(1).select(
        F.lit(run_date).alias("run_date"),
        as_timestamp(ingested_at).alias("ingested_at"),
        *[F.lit(int(rows)).cast("long").alias(source) for source, rows in counts.items()],
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/run_date={run_date}")


def in_parallel(*jobs: Callable[[], T_]) -> list[T_]:
    """Run independent writes at the same time, so one's last tasks do not leave executors idle."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [future.result() for future in [pool.submit(job) for job in jobs]]


class SplitCounts(NamedTuple):
    clean: int
    rejected: int


def save_clean_split(clean: DataFrame, rejected: DataFrame, folder: str, name: str) -> SplitCounts:
    """K3, K4: clean and rejected rows next to each other.

    Two narrow scans of a columnar landing are cheaper at scale than persisting the whole
    tagged frame, and nothing is lost with an executor.
    """
    return SplitCounts(
        *in_parallel(
            lambda: _write(clean, f"{folder}/{name}_clean", "overwrite"),
            lambda: _write(rejected, f"{folder}/rejected_{name}", "overwrite"),
        )
    )


def save_layer(df: DataFrame, path: str, *more: DataFrame) -> int:
    """K9: a layer that every run replaces.  ``more`` frames are added one after the other."""
    return _write(df, path, "overwrite") + sum(_write(rows, path, "append") for rows in more)


def month_slice(slices: int) -> Column:
    """The slice a month belongs to, from 0; neighbouring months lie in different ones."""
    return F.pmod(F.coalesce(F.col("TxYear") * 12 + F.col("TxMonth"), F.lit(0)), F.lit(slices))


def save_fact(
    fact: DataFrame, path: str, finish: Callable[[DataFrame], DataFrame] | None = None, slices: int = 1
) -> int:
    """K5: fact rows by year and month, so reports prune to the months they read.

    Rebalancing gathers a month's rows before the write, so a task does not leave a small file
    in every month; adaptive execution splits a month that is too large for one task.  ``finish`` adds columns
    that need no shuffle of their own, so they are not shuffled either.

    Several ``slices`` of the months are joined, gathered and written one after the other: no more than one of them is on
    the executors' disks as shuffle files.  Each scans the input, so pass a plan over stored tables.
    """
    rows = 0
    for n in range(slices):
        part = fact if slices == 1 else fact.where(month_slice(slices) == n)
        gathered = part.hint("rebalance", "TxYear", "TxMonth")
        counted, seen = _counted(finish(gathered) if finish else gathered)
        writer = counted.write.mode("append" if n else "overwrite").option("compression", CODEC)
        writer.partitionBy("TxYear", "TxMonth").parquet(path)
        rows += int(seen.get["rows"])
    return rows


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; absent columns are null.

    Doubles round to the declared scale of a decimal, but never to a whole number.  A value the type
    cannot hold becomes null; a load sets its row aside.
    """
    return df.select(*_conformed(df, schema))


def _conformed(df: DataFrame, schema: T.StructType) -> list[Column]:
    columns = []
    for field in schema.fields:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)) and isinstance(
            df.schema[field.name].dataType, (T.DoubleType, T.FloatType, T.DecimalType)
        ):
            value = F.when(value == F.bround(value, 0), value)
        columns.append(value.try_cast(field.dataType).alias(field.name))
    return columns


class Load(NamedTuple):
    rows: int
    #: Rows with a value that does not fit its declared type; they are in ``rejected_<table>``.
    unfit: int


def _misfits(df: DataFrame, schema: T.StructType, typed: str) -> dict[str, Column]:
    """By column name, whether its value is there but does not fit; typed values have the prefix ``typed``."""
    given = [f.name for f in schema.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    return {c: F.col(f"`{c}`").isNotNull() & F.col(f"`{typed}{c}`").isNull() for c in given}


def _stage(df: DataFrame, warehouse: str, table: str, key: str | None = None) -> snapshots.Part:
    """Write rows into a new part of a table; no reader sees it before it is published."""
    path = snapshots.new_part(warehouse, table)
    rows = _write(df, path, "errorifexists")
    return snapshots.Part(path.rsplit("/", 1)[1], rows, df.schema.json(), key)


class _Staged(NamedTuple):
    load: Load
    changes: dict[str, snapshots.Change]


def _staged(df: DataFrame, warehouse: str, table: str, operation: str, loaded_at) -> _Staged:
    """Typed rows and the ones set aside, written but not published; an empty frame changes nothing.

    The write of the typed rows counts the others, which are only scanned for if there are any.
    """
    if df.isEmpty():
        return _Staged(Load(0, 0), {})
    schema, prefix = TABLE_SCHEMAS[table], "_typed_"
    both = df.select("*", *[c.alias(f"{prefix}{f.name}") for f, c in zip(schema.fields, _conformed(df, schema))])
    lost = _misfits(df, schema, prefix)
    unfit = reduce(or_, lost.values(), F.lit(False))
    seen = Observation()
    typed = both.observe(seen, F.count_if(unfit).alias("unfit")).where(~unfit)
    typed = typed.select(*[F.col(f"`{prefix}{c}`").alias(c) for c in schema.names])
    names = [F.when(is_lost, F.lit(c)) for c, is_lost in lost.items()]
    named = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    aside = both.where(unfit).withColumn("unfit_columns", named).select(*df.columns, "unfit_columns")
    if loaded_at is not None:
        typed = typed.withColumn(LOADED_AT, as_timestamp(loaded_at))
        aside = aside.withColumn(LOADED_AT, as_timestamp(loaded_at))
    kept = _stage(typed, warehouse, table)
    parts = (kept, _stage(aside if seen.get["unfit"] else aside.limit(0), warehouse, f"rejected_{table}"))
    changes = {t: snapshots.Change(operation, (part,)) for t, part in zip((table, f"rejected_{table}"), parts)}
    return _Staged(Load(*(part.rows for part in parts)), changes)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _publish(df: DataFrame, warehouse: str, staged: _Staged, loaded_at) -> Load:
    if staged.changes:
        snapshots.publish(df.sparkSession, warehouse, staged.changes, loaded_at or _now())
    return staged.load


def replace_table(df: DataFrame, warehouse: str, table: str, loaded_at: str | datetime) -> Load:
    """K6: replace a warehouse table, stamped with the load time; an empty frame changes nothing.

    The old rows are read until the new ones are complete, and stay readable as the version before.
    Pass a stored layer: the emptiness probe then reads one row group, not a whole plan.
    """
    return _publish(df, warehouse, _staged(df, warehouse, table, "replace", loaded_at), loaded_at)


def append_table(df: DataFrame, warehouse: str, table: str, loaded_at: str | datetime | None = None) -> Load:
    """K7: add rows without touching the ones already there; all of them appear, or none."""
    return _publish(df, warehouse, _staged(df, warehouse, table, "append", loaded_at), loaded_at)


def replace_dq_results(results: DataFrame, warehouse: str, run_date: str) -> int:
    """The check history with one set of results per run date: a second run of a day replaces its own."""
    dated = conform(results, TABLE_SCHEMAS["dq_results"]).where(F.col("run_date") == F.lit(run_date).cast("date"))
    part = _stage(dated, warehouse, "dq_results", run_date)
    parts = (part,) if part.rows else ()
    snapshots.publish(results.sparkSession, warehouse, {"dq_results": snapshots.Change("replace_key", parts, run_date)}, _now())
    return part.rows


def append_dq_results(results: DataFrame, warehouse: str) -> Load:
    """K7 for the check history."""
    return append_table(results, warehouse, "dq_results")


def load_all(
    customers: DataFrame,
    transactions: DataFrame,
    fact: DataFrame,
    warehouse: str,
    loaded_at: str | datetime,
    holidays: DataFrame | None = None,
) -> dict[str, int]:
    """K8: replace every warehouse table and return the rows loaded; no calendar, no entry for it.

    All tables are published as one version: readers see the old ones together, then the new ones.
    Rows set aside because a value does not fit are counted under ``<table>_unfit``.
    """
    frames = {"stg_customers": customers, "stg_transactions": transactions, "fct_transactions": fact}
    if holidays is not None:
        frames["dim_holidays"] = holidays
    staged = in_parallel(*[partial(_staged, df, warehouse, t, "replace", loaded_at) for t, df in frames.items()])
    changes = {table: change for one in staged for table, change in one.changes.items()}
    if changes:
        snapshots.publish(fact.sparkSession, warehouse, changes, loaded_at)
    loads = [one.load for one in staged]
    counts = {t: load.rows for t, load in zip(frames, loads)}
    unfit = {f"{t}_unfit": load.unfit for t, load in zip(frames, loads) if load.unfit}
    return {t: n for t, n in counts.items() if n or t != "dim_holidays"} | unfit
