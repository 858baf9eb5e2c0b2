"""Sources: CSV exports, JSON holiday calendars and the pipeline's own layers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritill.model import HOLIDAY_COUNTRIES, ROW_ID, TABLE_SCHEMAS
from veritill.sources import snapshots
from veritill.sources.quoted_csv import read_quoted

# Texts that CSV exports use for a missing value.
MISSING_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

_HOLIDAY_DOCUMENT = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("localName", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("global", T.BooleanType()),
        T.StructField("countryCode", T.StringType()),
    ]
)


_RECORD = "_malformed_record"


def mark_missing(df: DataFrame) -> DataFrame:
    """Null for the texts that exports use for a missing value."""
    columns = [
        F.when(~F.col(f"`{f.name}`").isin(*MISSING_TEXTS), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*columns)


def read_csv(spark: SparkSession, path: str, multiline: bool = False, as_delivered: bool = False) -> DataFrame:
    """Every column of a CSV export as text, plus ``_row_id``.

    The header names the columns, so the name checks see what was really delivered.  ``_row_id``
    orders rows by file name, then block, then position, whatever order Spark packs the splits
    in; the folder only enters as a hash, as the column travels through the cleaning shuffle.
    ``multiline`` accepts line breaks inside quotes; such files are read by many tasks too.
    ``as_delivered`` leaves texts that stand for a missing value as they are.
    """
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    names = raw.columns
    if multiline:
        found = read_quoted(spark, path, names, ROW_ID)
        return found if as_delivered else mark_missing(found)
    position = F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.xxhash64("_metadata.file_path").alias("folder"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    found = raw.select(*[F.col(f"`{c}`") for c in names], position.alias(ROW_ID))
    return found if as_delivered else mark_missing(found)


def _dated(df: DataFrame, run_date: str | None) -> DataFrame:
    return df if run_date is None else df.withColumn("run_date", F.lit(run_date).cast("date"))


def read_transactions(
    spark: SparkSession, source_dir: str, run_date: str | None = None, multiline: bool = False, as_delivered: bool = False
) -> DataFrame:
    """``transactions.csv`` of a delivery folder."""
    return _dated(read_csv(spark, f"{source_dir}/transactions.csv", multiline, as_delivered), run_date)


def read_customers(
    spark: SparkSession, source_dir: str, run_date: str | None = None, multiline: bool = False, as_delivered: bool = False
) -> DataFrame:
    """S3: ``customers.csv`` of a delivery folder."""
    return _dated(read_csv(spark, f"{source_dir}/customers.csv", multiline, as_delivered), run_date)


def malformed_rows(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Text of the rows whose number of fields is not that of the header, or with an open quote."""
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multiline)
    )
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _RECORD]])
    rows = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD).csv(path)
    # all fields are named, as the reader does not count fields that nobody asks for
    kept = rows.select(F.col(_RECORD).alias("record"), F.array(*[F.col(f"`{c}`") for c in names]).alias("fields"))
    return kept.where(F.col("record").isNotNull())


def empty_holidays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TABLE_SCHEMAS["dim_holidays"])


def read_holidays(
    spark: SparkSession,
    path: str,
    countries: Sequence[str] | None = HOLIDAY_COUNTRIES,
    year: int | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Holiday documents delivered as JSON, one calendar row each.

    Without ``countries`` or ``year`` the calendar is not restricted.  A calendar that cannot be
    found is an empty one, as enrichment is optional.
    """
    try:
        documents = spark.read.schema(_HOLIDAY_DOCUMENT).option("multiLine", multiline).json(path)
    except AnalysisException:
        return empty_holidays(spark)
    days = documents.select(
        F.col("countryCode").alias("country_code"),
        F.col("date").try_cast("date").alias("date"),
        F.col("localName").alias("local_name"),
        "name",
        F.coalesce("global", F.lit(True)).alias("is_global"),
    )
    if countries is not None:
        days = days.where(F.col("country_code").isin(*countries))
    if year is not None:
        days = days.where(F.year("date") == year)
    return days


def read_layer(spark: SparkSession, path: str, run_date: str | None = None) -> DataFrame | None:
    """A stored layer, or one run of it; None when it was never written."""
    try:
        layer = spark.read.parquet(path)
    except AnalysisException:
        return None
    if run_date is not None and "run_date" in layer.columns:
        layer = layer.where(F.col("run_date") == F.lit(run_date).cast("date"))
    return layer


def latest_run(layer: DataFrame, column: str = "run_date") -> DataFrame:
    """Rows of the newest run.

    The runs are partitions, so the newest one is known from the paths that the reader has listed;
    the scan is pruned to it.  A layer without such partitions has its newest value looked up.
    """
    runs = [found[1] for found in (re.search(rf"/{column}=([^/]+)/", f) for f in layer.inputFiles()) if found]
    if not runs:
        return layer.where(F.col(column) == layer.select(F.max(column)).scalar())
    return layer.where(F.col(column) == F.lit(max(runs)).cast(layer.schema[column].dataType))


def latest_manifest(
    spark: SparkSession, path: str, sources: Sequence[str] = ("transactions", "customers", "holidays")
) -> DataFrame:
    """Counts of the newest run's manifest; zero for a source it does not name, or without any manifest."""
    schema = T.StructType(
        [T.StructField("run_date", T.DateType()), T.StructField("ingested_at", T.StringType())]
        + [T.StructField(source, T.LongType()) for source in sources]
    )
    try:
        newest = latest_run(spark.read.schema(schema).json(path))
    except AnalysisException:
        newest = spark.createDataFrame([], schema)
    counts = [F.coalesce(F.max(source), F.lit(0)).alias(source) for source in sources]
    return newest.agg(F.max("run_date").alias("run_date"), F.max("ingested_at").alias("ingested_at"), *counts)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """Fact rows for reporting, with their calendar day."""
    return with_day(spark.read.parquet(path))


def with_day(fact: DataFrame) -> DataFrame:
    return fact.withColumn("date", F.to_date("InvoiceDate"))


def read_table(spark: SparkSession, warehouse: str, table: str, version: int | None = None) -> DataFrame:
    """A warehouse table under its declared schema, with the load time; as of an earlier version if one is named."""
    schema = T.StructType(TABLE_SCHEMAS[table].fields + [T.StructField("_loaded_at", T.TimestampType())])
    return snapshots.read(spark, warehouse, table, version, schema=schema)
