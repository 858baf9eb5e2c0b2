"""The operators applied to the adapted tables; every frame is lazy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritill.catalogue import adapters
from veritill.catalogue.adapters import AS_OF
from veritill.functions import strip
from veritill.operators import cleaning, enrich, quality
from veritill.session import drop_scratch, scratch_dir
from veritill.sources.sinks import FACT_SLICES, in_parallel, save_fact, save_layer


def typed_tx(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.type_transactions(adapters.raw_transactions(spark, sf))


def split_tx(spark: SparkSession, sf: str) -> cleaning.Split:
    return cleaning.clean_transactions(adapters.raw_transactions(spark, sf), AS_OF)


def split_cu(spark: SparkSession, sf: str) -> cleaning.Split:
    return cleaning.clean_customers(adapters.raw_customers(spark, sf))


def clean_tx(spark: SparkSession, sf: str) -> DataFrame:
    return split_tx(spark, sf).clean


def raw_slices(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The raw transactions in slices, for steps that store them: the shuffle files of one slice lie on disk at a time."""
    return [adapters.raw_transactions(spark, sf, exported=True, nth=n) for n in range(adapters.ORDER_SLICES)]


def clean_slices(spark: SparkSession, sf: str) -> list[DataFrame]:
    """``clean_tx`` in slices; the rows of an invoice lie in one of them, so each is de-duplicated by itself."""
    raw = [adapters.raw_transactions(spark, sf, nth=n) for n in range(adapters.ORDER_SLICES)]
    return [cleaning.clean_transactions(rows, AS_OF).clean for rows in raw]


def clean_cu(spark: SparkSession, sf: str) -> DataFrame:
    return split_cu(spark, sf).clean


def numbered_tx(spark: SparkSession, sf: str) -> cleaning.Split:
    """``split_tx`` with the lines joined by number: one shuffle more, and no sort that works texts out."""
    return cleaning.clean_transactions(adapters.raw_transactions(spark, sf, exported=True), AS_OF)


def fact(spark: SparkSession, sf: str, holidays: bool = True) -> DataFrame:
    calendar = adapters.holidays(spark, sf) if holidays else None
    return enrich.build_fact(clean_tx(spark, sf), clean_cu(spark, sf), calendar)


def numbered_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact table for aggregates that read a few of its columns: the shuffle saved in ``fact`` is cheaper than its sort."""
    return enrich.build_fact(numbered_tx(spark, sf).clean, clean_cu(spark, sf), adapters.holidays(spark, sf))


def saved_fact(spark: SparkSession, sf: str, path: str) -> int:
    """The fact table as a run saves it, by year and month, from stored clean tables and a stored calendar."""
    first, *others = clean_slices(spark, sf)
    with passing(first, "transactions", *others) as tx:
        cu, calendar = in_parallel(
            lambda: stored(clean_cu(spark, sf), "customers"), lambda: stored(adapters.holidays(spark, sf), "holidays")
        )
        joined = enrich.join_customers(tx, cu)
        return save_fact(joined, path, lambda rows: enrich.finish_fact(rows, calendar), FACT_SLICES)


def clean_parts(raw: DataFrame) -> list[DataFrame]:
    """Clean transactions of a stored raw table, in slices by the number that de-duplication sees."""
    part = F.pmod(F.xxhash64(strip(F.col("InvoiceNo"))), F.lit(adapters.ORDER_SLICES))
    return [cleaning.clean_transactions(raw.where(part == n), AS_OF).clean for n in range(adapters.ORDER_SLICES)]


class Layers(NamedTuple):
    transactions: DataFrame
    customers: DataFrame
    fact: DataFrame


def stored(df: DataFrame, label: str, *more: DataFrame) -> DataFrame:
    """The rows of a frame, and of those after it, as a stored table in the shared scratch folder."""
    path = scratch_dir(df.sparkSession, label)
    save_layer(df, path, *more)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(df: DataFrame, label: str, *more: DataFrame) -> Iterator[DataFrame]:
    """As ``stored``, but the table goes when the block ends: no later step reads it."""
    path = scratch_dir(df.sparkSession, label)
    try:
        save_layer(df, path, *more)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        drop_scratch(df.sparkSession, path)


def stored_raw(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Both raw exports as a run lands them, for queries that read them several times."""
    first, *others = raw_slices(spark, sf)
    tx, cu = in_parallel(
        lambda: stored(first, "raw-transactions", *others),
        lambda: stored(adapters.raw_customers(spark, sf), "raw-customers"),
    )
    return tx, cu


def stored_layers(spark: SparkSession, sf: str) -> Layers:
    """Clean and fact tables as a run stores them, for suites that read each several times."""
    tx, cu = in_parallel(
        lambda: stored(clean_tx(spark, sf), "transactions"), lambda: stored(clean_cu(spark, sf), "customers")
    )
    fact_rows = enrich.build_fact(tx, cu, adapters.holidays(spark, sf))
    return Layers(tx, cu, stored(fact_rows, "fact"))


def checked_layers(
    spark: SparkSession, sf: str, raw: tuple[DataFrame, DataFrame] | None = None, besides: Sequence[str] = ()
) -> Layers:
    """All rows of the three layers, stored with the columns that the quality suites read: no other one is shuffled.

    ``besides`` are columns of the transactions that other checks read from the fact table.
    """
    raw_cu = raw[1] if raw else adapters.raw_customers(spark, sf)
    first, *others = clean_parts(raw[0]) if raw else clean_slices(spark, sf)
    checked_fact = tuple(dict.fromkeys((*quality.CHECKED_FACT, *besides)))
    used = dict.fromkeys((*quality.CHECKED_TRANSACTIONS, *checked_fact))
    tx, cu = in_parallel(
        lambda: stored(first.select(*used), "transactions", *[rows.select(*used) for rows in others]),
        lambda: stored(cleaning.clean_customers(raw_cu).clean.select(*quality.CHECKED_CUSTOMERS), "customers"),
    )
    fact_rows = enrich.build_fact(tx, cu, adapters.holidays(spark, sf)).select(*checked_fact)
    return Layers(tx.select(*quality.CHECKED_TRANSACTIONS), cu, stored(fact_rows, "fact"))


def stored_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact table alone, for suites that read nothing else."""
    return stored(fact(spark, sf), "fact")
