"""Queries over sources, sinks and the end-to-end run.

Each writes the adapted tables into a new scratch folder, reads them back and returns the rows
or their counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritill.catalogue import adapters, frames
from veritill.catalogue.adapters import AS_OF, RUN_DATE, plain
from veritill.catalogue.oracle import day_text, with_ctes
from veritill.catalogue.registry import query
from veritill.model import LOADED_AT, ROW_ID
from veritill.operators.checks import dq_table, run_rules
from veritill.operators.quality import STAGE, null_rates
from veritill.plans.report import counts_table
from veritill.plans.run import run_pipeline
from veritill.session import scratch_dir
from veritill.sources import files, sinks, snapshots

_NEXT_DATE = "2002-01-02"


def _write_csv(df: DataFrame, path: str, compression: str = "none", mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode).option("header", True).option("escape", '"').option("compression", compression)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _write_exports(spark, sf, folder: str) -> None:
    """Both CSV exports of a delivery, packed: a task reads a file, and there is one for every task that wrote rows."""
    for rows in frames.raw_slices(spark, sf):
        _write_csv(rows.drop("_row_id"), f"{folder}/transactions.csv", "gzip", "append")
    _write_csv(adapters.raw_customers(spark, sf).drop("_row_id"), f"{folder}/customers.csv", "gzip")


def _delivery(spark, sf, label: str) -> str:
    """The adapted tables as a delivery folder: two CSV exports and a JSON calendar."""
    folder = scratch_dir(spark, label)
    _write_exports(spark, sf, folder)
    _write_holidays(spark, sf, f"{folder}/holidays")
    return folder


def _write_holidays(spark, sf, path: str) -> None:
    documents = adapters.holidays(spark, sf).selectExpr(
        "cast(date as string) as date", "local_name as localName", "name", "is_global as global",
        "country_code as countryCode",
    )
    documents.write.json(path)


def _rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("row_count"))


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _counts(*pairs: tuple[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS layer, COUNT(*) AS row_count FROM {table}" for name, table in pairs)


# --------------------------------------------------------------------------- sources
@query(
    "s01_csv_scan",
    with_ctes(
        """SELECT "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID",
             "Country", "Status", "PaymentMethod" FROM raw_tx""",
        "raw_tx",
    ),
)
def s01(spark, sf):
    path = scratch_dir(spark, "csv")
    _write_csv(adapters.raw_transactions(spark, sf).drop("_row_id"), path)
    return files.read_csv(spark, path).drop("_row_id")


@query(
    "s01_quoted_breaks",
    with_ctes(
        """SELECT "InvoiceNo", "StockCode", "UnitPrice", concat_ws(chr(10), "Status", "Country") AS "Description"
           FROM raw_tx""",
        "raw_tx",
    ),
)
def s01_breaks(spark, sf):
    """Line breaks inside quotes: every row comes back whole."""
    path = scratch_dir(spark, "csv-breaks")
    texts = adapters.raw_transactions(spark, sf).select(
        "InvoiceNo", "StockCode", F.concat_ws("\n", "Status", "Country").alias("Description"), "UnitPrice"
    )
    _write_csv(texts, path)
    return files.read_csv(spark, path, multiline=True).drop("_row_id")


@query(
    "s01_malformed",
    with_ctes(
        """SELECT concat_ws(',', "InvoiceNo", "StockCode", 'surplus') AS record,
             concat_ws(',', "InvoiceNo", "StockCode") AS fields FROM raw_tx
           WHERE CAST("InvoiceNo" AS BIGINT) % 7 = 0
           UNION ALL SELECT "InvoiceNo", "InvoiceNo" FROM raw_tx WHERE CAST("InvoiceNo" AS BIGINT) % 7 = 1""",
        "raw_tx",
    ),
)
def s01_malformed(spark, sf):
    """Rows with a field too many or too few: their text, and the fields the reader takes."""
    path = scratch_dir(spark, "csv-malformed")
    group = F.col("InvoiceNo").cast("bigint") % 7
    line = (
        F.when(group == 0, F.concat_ws(",", "InvoiceNo", "StockCode", F.lit("surplus")))
        .when(group == 1, F.col("InvoiceNo"))
        .otherwise(F.concat_ws(",", "InvoiceNo", "StockCode"))
    )
    rows = adapters.raw_transactions(spark, sf).select(line.alias("InvoiceNo,StockCode"))
    # each line is one field, below the header that the reader takes from every file; the separator does not occur
    rows.write.csv(
        path, header=True, sep="\x01", quote="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return files.malformed_rows(spark, path).select("record", F.array_join("fields", ",").alias("fields"))


@query(
    "s02_deliveries",
    with_ctes(
        f"""SELECT 'transactions' AS layer, '{RUN_DATE}' AS run_date, COUNT(*) AS row_count,
              COUNT("CustomerID") AS ids FROM raw_tx
            UNION ALL SELECT 'customers', '{RUN_DATE}', COUNT(*), COUNT("CustomerID") FROM raw_cu""",
        "raw_tx",
        "raw_cu",
    ),
)
def s02(spark, sf):
    folder = _delivery(spark, sf, "delivery")
    both = {
        "transactions": files.read_transactions(spark, folder, RUN_DATE),
        "customers": files.read_customers(spark, folder, RUN_DATE),
    }
    parts = [
        df.groupBy(F.lit(name).alias("layer"), "run_date").agg(
            F.count(F.lit(1)).alias("row_count"), F.count("CustomerID").alias("ids")
        )
        for name, df in both.items()
    ]
    return plain(_union(parts))


@query(
    "s04_holidays",
    with_ctes(
        f"""SELECT country_code, {day_text("date")} AS date, local_name, name,
              CAST(COALESCE(is_global, TRUE) AS VARCHAR) AS is_global
            FROM holidays WHERE country_code IN ('GB', 'DE', 'FR', 'US') AND year(date) = 1997""",
        "holidays",
    ),
)
def s04(spark, sf):
    path = scratch_dir(spark, "holidays")
    _write_holidays(spark, sf, path)
    return plain(files.read_holidays(spark, path, year=1997))


@query("s05_layer", with_ctes('SELECT "CustomerID", "Country" FROM clean_cu', "clean_cu"))
def s05(spark, sf):
    path = scratch_dir(spark, "layer")
    sinks.save_layer(frames.clean_cu(spark, sf), path)
    return files.read_layer(spark, path).select("CustomerID", "Country")


@query(
    "s06_latest_run",
    f"SELECT '{_NEXT_DATE}' AS run_date, o_orderstatus, COUNT(*) AS row_count FROM orders GROUP BY ALL",
)
def s06(spark, sf):
    path = scratch_dir(spark, "runs")
    orders = adapters.table(spark, sf, "orders")
    for day in (RUN_DATE, _NEXT_DATE):
        sinks.land_raw(orders, path, day)
    newest = files.latest_run(files.read_layer(spark, path))
    return plain(newest.groupBy("run_date", "o_orderstatus").agg(F.count(F.lit(1)).alias("row_count")))


@query(
    "s07_fact_days",
    with_ctes(
        f"""SELECT {day_text('"InvoiceDate"')} AS date, "TxYear", COUNT(*) AS row_count FROM fact GROUP BY ALL""", "fact"
    ),
)
def s07(spark, sf):
    path = scratch_dir(spark, "fact")
    frames.saved_fact(spark, sf, path)
    days = files.read_fact(spark, path).groupBy("date", "TxYear")
    return plain(days.agg(F.count(F.lit(1)).alias("row_count")))


@query(
    "s06_latest_manifest",
    with_ctes(
        f"""SELECT '{_NEXT_DATE}' AS run_date, (SELECT COUNT(*) FROM raw_tx) AS transactions,
              (SELECT COUNT(*) FROM raw_cu) AS customers, CAST(0 AS BIGINT) AS holidays""",
        "raw_tx",
        "raw_cu",
    ),
)
def s06_manifest(spark, sf):
    """Of two runs the newer manifest, without a calendar."""
    path = scratch_dir(spark, "manifests")
    counts = {"transactions": adapters.raw_transactions(spark, sf).count(), "customers": adapters.raw_customers(spark, sf).count()}
    sinks.write_manifest(spark, path, RUN_DATE, {"transactions": 1, "customers": 1, "holidays": 1}, AS_OF)
    sinks.write_manifest(spark, path, _NEXT_DATE, counts, AS_OF)
    return plain(files.latest_manifest(spark, path)).select("run_date", "transactions", "customers", "holidays")


# --------------------------------------------------------------------------- sinks
@query(
    "k06_unfit_rows",
    with_ctes(
        """SELECT 'stg_transactions' AS layer, COUNT(*) FILTER (WHERE CAST("InvoiceNo" AS BIGINT) % 5 > 1) AS row_count
           FROM clean_tx
           UNION ALL SELECT 'UnitPrice', COUNT(*) FILTER (WHERE CAST("InvoiceNo" AS BIGINT) % 5 = 0) FROM clean_tx
           UNION ALL SELECT 'Quantity', COUNT(*) FILTER (WHERE CAST("InvoiceNo" AS BIGINT) % 5 = 1) FROM clean_tx""",
        "clean_tx",
    ),
)
def k06_unfit(spark, sf):
    """Prices that are too large and broken quantities: their rows are set aside whole, with the column named."""
    path, tx = scratch_dir(spark, "warehouse"), frames.clean_tx(spark, sf)
    group = F.col("InvoiceNo").cast("bigint") % 5
    odd = tx.withColumns({
        "UnitPrice": F.when(group == 0, F.lit(123456789012.0)).otherwise(F.col("UnitPrice")),
        "Quantity": F.when(group == 1, F.lit(2.5)).otherwise(F.col("Quantity").cast("double")),
    })
    sinks.replace_table(frames.stored(odd, "odd"), path, "stg_transactions", AS_OF)
    aside = snapshots.read(spark, path, "rejected_stg_transactions")
    named = aside.select(F.explode("unfit_columns").alias("layer")).where(F.col("layer") != "LineTotal")
    return _rows(files.read_table(spark, path, "stg_transactions"), "stg_transactions").unionByName(
        named.groupBy("layer").agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "k01_landing",
    with_ctes(
        f"""SELECT '{RUN_DATE}' AS run_date, COUNT(*) AS row_count FROM raw_tx
            UNION ALL SELECT '{_NEXT_DATE}', COUNT(*) FROM raw_cu""",
        "raw_tx",
        "raw_cu",
    ),
)
def k01(spark, sf):
    """One day landed twice and another once: the second landing replaces its own day only."""
    path = scratch_dir(spark, "landing")
    tx, cu = adapters.raw_transactions(spark, sf).drop(ROW_ID), adapters.raw_customers(spark, sf).drop(ROW_ID)
    sinks.land_raw(cu, path, RUN_DATE)
    sinks.land_raw(cu, path, _NEXT_DATE)
    sinks.land_raw(tx, path, RUN_DATE)
    landed = spark.read.parquet(path).groupBy("run_date")
    return plain(landed.agg(F.count(F.lit(1)).alias("row_count")))


@query(
    "k02_manifest",
    with_ctes(
        f"""SELECT '{RUN_DATE}' AS run_date, (SELECT COUNT(*) FROM raw_tx) AS transactions,
              (SELECT COUNT(*) FROM raw_cu) AS customers, (SELECT COUNT(*) FROM holidays) AS holidays""",
        "raw_tx",
        "raw_cu",
        "holidays",
    ),
)
def k02(spark, sf):
    path = scratch_dir(spark, "manifest")
    counts = {
        "transactions": sinks.land_raw(adapters.raw_transactions(spark, sf), f"{path}/tx", RUN_DATE),
        "customers": sinks.land_raw(adapters.raw_customers(spark, sf), f"{path}/cu", RUN_DATE),
        "holidays": sinks.land_raw(adapters.holidays(spark, sf), f"{path}/holidays", RUN_DATE),
    }
    sinks.write_manifest(spark, f"{path}/manifest", RUN_DATE, counts, AS_OF)
    manifest = spark.read.json(f"{path}/manifest").withColumn("run_date", F.col("run_date").cast("string"))
    return manifest.select("run_date", "transactions", "customers", "holidays")


@query(
    "k03_clean_quarantine",
    with_ctes(
        _counts(
            ("transactions_clean", "clean_tx"),
            ("rejected_transactions", """tagged_tx WHERE "_reject_reason" <> '' """),
            ("customers_clean", "clean_cu"),
            ("rejected_customers", """raw_cu WHERE "CustomerID" IS NULL"""),
        ),
        "clean_tx",
        "clean_cu",
    ),
)
def k03(spark, sf):
    path = scratch_dir(spark, "interim")
    sinks.save_clean_split(*frames.split_tx(spark, sf), path, "transactions")
    sinks.save_clean_split(*frames.split_cu(spark, sf), path, "customers")
    layers = ("transactions_clean", "rejected_transactions", "customers_clean", "rejected_customers")
    return _union([_rows(spark.read.parquet(f"{path}/{name}"), name) for name in layers])


@query(
    "k05_fact",
    with_ctes('SELECT "TxYear", "TxMonth", COUNT(*) AS row_count FROM fact GROUP BY ALL', "fact"),
)
def k05(spark, sf):
    path = scratch_dir(spark, "fact")
    frames.saved_fact(spark, sf, path)
    months = spark.read.parquet(path).groupBy("TxYear", "TxMonth")
    return months.agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "k06_replace_twice",
    with_ctes(
        f"""SELECT "CustomerID", "Country", "Segment", '{AS_OF}' AS "{LOADED_AT}" FROM clean_cu""", "clean_cu"
    ),
)
def k06(spark, sf):
    """Loading twice does not double the rows; an empty frame leaves the table alone."""
    path = scratch_dir(spark, "warehouse")
    cu = frames.clean_cu(spark, sf)
    sinks.replace_table(cu, path, "stg_customers", "2001-12-31 00:00:00")
    sinks.replace_table(cu, path, "stg_customers", AS_OF)
    sinks.replace_table(cu.where("false"), path, "stg_customers", "2002-01-05 00:00:00")
    loaded = files.read_table(spark, path, "stg_customers")
    return plain(loaded.select("CustomerID", "Country", "Segment", LOADED_AT))


@query(
    "k07_append_twice",
    with_ctes(
        f"""SELECT run_date, "table", "check", COUNT(*) AS row_count
            FROM (SELECT '{RUN_DATE}' AS run_date UNION ALL SELECT '{RUN_DATE}' UNION ALL SELECT '{_NEXT_DATE}'),
              (SELECT 'stg_transactions' AS "table", 'null_rate.CustomerID' AS "check" FROM raw_tx LIMIT 1)
            GROUP BY ALL""",
        "raw_tx",
    ),
)
def k07(spark, sf):
    """The history keeps every append, also a second one of the same day."""
    path = scratch_dir(spark, "history")
    tx = adapters.raw_transactions(spark, sf)
    rules = null_rates(tx, "stg_transactions", ["CustomerID"])
    for day in (RUN_DATE, RUN_DATE, _NEXT_DATE):
        sinks.append_dq_results(dq_table(run_rules(tx, rules, STAGE, AS_OF, day)), path)
    history = snapshots.read(spark, path, "dq_results").groupBy("run_date", "table", "check")
    return plain(history.agg(F.count(F.lit(1)).alias("row_count")))


@query(
    "k07_rerun",
    with_ctes(
        f"""SELECT run_date, "table", "check", COUNT(*) AS row_count
            FROM (SELECT '{RUN_DATE}' AS run_date UNION ALL SELECT '{_NEXT_DATE}'),
              (SELECT 'stg_transactions' AS "table", 'null_rate.CustomerID' AS "check" FROM raw_tx LIMIT 1)
            GROUP BY ALL""",
        "raw_tx",
    ),
)
def k07_rerun(spark, sf):
    """A run that is repeated replaces the results of its day."""
    path = scratch_dir(spark, "history")
    tx = adapters.raw_transactions(spark, sf)
    rules = null_rates(tx, "stg_transactions", ["CustomerID"])
    for day in (RUN_DATE, _NEXT_DATE, RUN_DATE):
        sinks.replace_dq_results(dq_table(run_rules(tx, rules, STAGE, AS_OF, day)), path, day)
    history = snapshots.read(spark, path, "dq_results").groupBy("run_date", "table", "check")
    return plain(history.agg(F.count(F.lit(1)).alias("row_count")))


@query(
    "k08_load_counts",
    with_ctes(
        _counts(
            ("stg_customers", "clean_cu"),
            ("stg_transactions", "clean_tx"),
            ("fct_transactions", "fact"),
            ("dim_holidays", "holidays"),
        ),
        "fact",
    ),
)
def k08(spark, sf):
    path = scratch_dir(spark, "warehouse")
    tx, cu, fact = frames.stored_layers(spark, sf)
    calendar = frames.stored(adapters.holidays(spark, sf), "holidays")
    counts = sinks.load_all(cu, tx, fact, path, AS_OF, calendar)
    return _union([_rows(files.read_table(spark, path, name), name) for name in counts])


@query(
    "k06_previous_version",
    with_ctes(
        """SELECT 'previous' AS version, "Country", COUNT(*) AS row_count FROM clean_cu GROUP BY ALL
           UNION ALL SELECT 'current', "Country", COUNT(*) FROM clean_cu WHERE CAST("CustomerID" AS BIGINT) % 3 = 0 GROUP BY ALL""",
        "clean_cu",
    ),
)
def k06_previous(spark, sf):
    """After a load that replaces a table, the table as of the version before and as it is now."""
    path, cu = scratch_dir(spark, "warehouse"), frames.stored(frames.clean_cu(spark, sf), "customers")
    sinks.replace_table(cu, path, "stg_customers", "2001-12-31 00:00:00")
    before = snapshots.current(spark, path).number
    sinks.replace_table(cu.where(F.col("CustomerID").cast("bigint") % 3 == 0), path, "stg_customers", AS_OF)
    parts = [("previous", before), ("current", None)]
    return _union([
        files.read_table(spark, path, "stg_customers", version).groupBy(F.lit(name).alias("version"), "Country").agg(
            F.count(F.lit(1)).alias("row_count"))
        for name, version in parts
    ])


@query(
    "k08_stopped_load",
    with_ctes(
        """SELECT 'stg_customers' AS layer, '2001-12-31 00:00:00' AS loaded_at, COUNT(*) AS row_count FROM clean_cu
           UNION ALL SELECT 'stg_transactions', '2001-12-31 00:00:00', COUNT(*) FROM clean_tx
           UNION ALL SELECT 'fct_transactions', '2001-12-31 00:00:00', COUNT(*) FROM fact""",
        "fact",
    ),
)
def k08_stopped(spark, sf):
    """A second load of all tables that dies while it writes one of them: every table is the one of the first load, whole."""
    path = scratch_dir(spark, "warehouse")
    tx, cu, fact = frames.stored_layers(spark, sf)
    sinks.load_all(cu, tx, fact, path, "2001-12-31 00:00:00")
    dies = F.when(F.col("InvoiceNo").cast("bigint") % 5 == 0, F.raise_error(F.lit("stopped"))).otherwise(F.col("Country"))
    try:
        sinks.load_all(cu, tx.withColumn("Country", dies), fact, path, AS_OF)
    except Exception as stopped:
        if "stopped" not in str(stopped):
            raise
    return _union([
        files.read_table(spark, path, name).groupBy(F.lit(name).alias("layer"), F.col(LOADED_AT).cast("string").alias("loaded_at"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        for name in ("stg_customers", "stg_transactions", "fct_transactions")
    ])


@query(
    "k10_typed_tables",
    with_ctes(
        """SELECT "InvoiceNo", "StockCode", CAST("Quantity" AS INTEGER) AS "Quantity",
             "UnitPrice", "LineTotal", customer_tenure_days, "CountryISO2" FROM fact""",
        "fact",
    ),
)
def k10(spark, sf):
    """The fact table under its declared warehouse types."""
    path = scratch_dir(spark, "warehouse")
    sinks.replace_table(frames.stored(frames.fact(spark, sf), "fact"), path, "fct_transactions", AS_OF)
    loaded = files.read_table(spark, path, "fct_transactions")
    return plain(
        loaded.select(
            "InvoiceNo", "StockCode", "Quantity", "UnitPrice", "LineTotal", "customer_tenure_days", "CountryISO2"
        )
    )


# --------------------------------------------------------------------------- whole run
_CALENDAR = """(SELECT * FROM holidays WHERE country_code IN ('GB', 'DE', 'FR', 'US') AND year(date) = 1997)"""


@query(
    "p01_empty_delivery",
    with_ctes(
        _counts(("customers", "raw_cu"), ("customers_clean", "clean_cu"), ("transactions", "raw_cu WHERE FALSE"),
                ("transactions_clean", "raw_cu WHERE FALSE"), ("fact", "raw_cu WHERE FALSE"))
        + " UNION ALL SELECT 'status_code', CAST(1 AS BIGINT)",
        "raw_cu",
        "clean_cu",
    ),
)
def p01_empty(spark, sf):
    """An export with a header and no rows, after a run of the same day that had rows."""
    folder = scratch_dir(spark, "empty-run")
    _write_exports(spark, sf, folder)
    run_pipeline(spark, folder, f"{folder}/out", RUN_DATE, AS_OF, warehouse=False)
    names = adapters.raw_transactions(spark, sf, exported=True).drop("_row_id").columns
    header = spark.createDataFrame([(",".join(names),)], "value string")
    header.coalesce(1).write.mode("overwrite").text(f"{folder}/transactions.csv")
    result = run_pipeline(spark, folder, f"{folder}/out", RUN_DATE, AS_OF, warehouse=False)
    names = ("customers", "customers_clean", "transactions", "transactions_clean", "fact")
    counts = {name: result.counts[name] for name in names} | {"status_code": result.code}
    return counts_table(spark, counts, "layer")


@query(
    "p01_run",
    with_ctes(
        _counts(
            ("transactions", "raw_tx"),
            ("customers", "raw_cu"),
            ("holidays", _CALENDAR),
            ("transactions_clean", "clean_tx"),
            ("transactions_rejected", """tagged_tx WHERE "_reject_reason" <> '' """),
            ("customers_clean", "clean_cu"),
            ("customers_rejected", """raw_cu WHERE "CustomerID" IS NULL"""),
            ("fact", "clean_tx"),
            ("loaded_stg_customers", "clean_cu"),
            ("loaded_stg_transactions", "clean_tx"),
            ("loaded_fct_transactions", "clean_tx"),
            ("loaded_dim_holidays", _CALENDAR),
        )
        + """ UNION ALL SELECT 'status_code', CAST(1 AS BIGINT)
              UNION ALL SELECT 'transactions_duplicate', (SELECT COUNT(*) FROM tagged_tx WHERE "_reject_reason" = '')
                - (SELECT COUNT(*) FROM clean_tx)
              UNION ALL SELECT 'customers_duplicate', (SELECT COUNT("CustomerID") FROM raw_cu)
                - (SELECT COUNT(*) FROM clean_cu)""",
        "clean_tx",
        "clean_cu",
        "holidays",
    ),
)
def p01(spark, sf):
    """A whole run over a delivery of the adapted tables: rows per layer and the status code."""
    folder = _delivery(spark, sf, "run")
    result = run_pipeline(
        spark, folder, f"{folder}/out", RUN_DATE, AS_OF, holidays_path=f"{folder}/holidays", holiday_year=1997
    )
    return counts_table(spark, result.counts | {"status_code": result.code}, "layer")
