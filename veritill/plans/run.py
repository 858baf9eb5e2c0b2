"""End-to-end run (P1): exports in, trusted tables, check history and report out."""

from __future__ import annotations

import logging
from datetime import date, datetime, timezone
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritill.model import HOLIDAY_COUNTRIES
from veritill.operators.anomalies import run_anomaly_detection
from veritill.operators.checks import dq_table
from veritill.operators.cleaning import clean_customers, clean_transactions
from veritill.operators.enrich import finish_fact, join_customers
from veritill.operators.quality import run_quality_checks
from veritill.operators.validation import validate_raw
from veritill.plans.report import counts_table, report_tables, run_verdict, save_report
from veritill.session import shuffles_freed
from veritill.sources import files, sinks

log = logging.getLogger(__name__)


class RunResult(NamedTuple):
    #: 0 clean, 1 finished with findings, 2 aborted.
    code: int
    #: Rows per source, layer and warehouse table.
    counts: dict[str, int]
    #: Folder of the run's layers.
    out: str


def run_pipeline(
    spark: SparkSession,
    source_dir: str,
    out: str,
    run_date: str | None = None,
    as_of: str | datetime | None = None,
    holidays_path: str | None = None,
    holiday_countries: tuple[str, ...] | None = HOLIDAY_COUNTRIES,
    holiday_year: int | None = None,
    warehouse: bool = True,
    invoice_severity: str = "error",
    multiline: bool = False,
    salted: bool = False,
    include_current: bool = True,
    window: int | None = None,
    z_threshold: float | None = None,
) -> RunResult:
    """Run every stage and return its status code; findings never stop a run, errors give 2.

    Every stage reads the stored output of the one before, so a lost executor only repeats its
    own tasks and no stage recomputes another.  ``multiline`` reads line breaks inside quotes,
    ``salted`` spreads hot customers before the join, and the last three set the volume detector.
    A second run of a day replaces what the first one left of it.
    """
    now = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    day = run_date or date.today().isoformat()
    try:
        with shuffles_freed(spark):
            return _run(
                spark, source_dir, out, day, now, holidays_path, holiday_countries, holiday_year,
                warehouse, invoice_severity, multiline, salted,
                {"include_current": include_current, **({"window": window} if window else {}),
                 **({"z_threshold": z_threshold} if z_threshold is not None else {})},
            )
    except Exception:  # the contract of a run is a status code
        log.exception("run of %s aborted", day)
        return RunResult(2, {}, out)


def _land_holidays(spark, path, countries, year, raw, day) -> int:
    """Rows of the calendar landed; a calendar that cannot be read is an empty one."""
    try:
        return sinks.land_raw(files.read_holidays(spark, path, countries, year), raw, day)
    except Exception:
        log.exception("calendar skipped")
        return 0


def _run(
    spark, source_dir, out, day, now, holidays_path, holiday_countries, holiday_year, warehouse, invoice_severity,
    multiline, salted, volume,
) -> RunResult:
    stored = spark.read.parquet
    raw, interim = f"{out}/raw", f"{out}/interim"

    # land the exports as they are; columnar from here on
    exports = {
        "transactions": files.read_transactions(spark, source_dir, multiline=multiline, as_delivered=True),
        "customers": files.read_customers(spark, source_dir, multiline=multiline, as_delivered=True),
    }
    landings = [partial(sinks.land_raw, df, f"{raw}/{name}", day) for name, df in exports.items()]
    if holidays_path is not None:
        year = holiday_year or int(day[:4])
        landings.append(partial(_land_holidays, spark, holidays_path, holiday_countries, year, f"{raw}/holidays", day))
    names = [*exports, "holidays"][: len(landings)]
    counts = {"holidays": 0} | dict(zip(names, sinks.in_parallel(*landings)))
    holidays: DataFrame | None = None
    if counts["holidays"]:
        holidays = stored(f"{raw}/holidays/run_date={day}")
        sinks.save_layer(holidays, f"{interim}/holidays")
    sinks.write_manifest(spark, f"{out}/manifest", day, counts, now)
    ingested = dict(counts)

    tx_raw = files.mark_missing(stored(f"{raw}/transactions/run_date={day}"))
    cu_raw = files.mark_missing(stored(f"{raw}/customers/run_date={day}"))
    validation = validate_raw(tx_raw, cu_raw, now, day)

    tx_counts, cu_counts = sinks.in_parallel(
        partial(sinks.save_clean_split, *clean_transactions(tx_raw, now), interim, "transactions"),
        partial(sinks.save_clean_split, *clean_customers(cu_raw), interim, "customers"),
    )
    counts |= {
        "transactions_clean": tx_counts.clean,
        "transactions_rejected": tx_counts.rejected,
        "transactions_duplicate": ingested["transactions"] - sum(tx_counts),
        "customers_clean": cu_counts.clean,
        "customers_rejected": cu_counts.rejected,
        "customers_duplicate": ingested["customers"] - sum(cu_counts),
    }

    for name in exports:
        if counts[f"{name}_duplicate"] < 0:
            raise RuntimeError(f"more {name} cleaned or rejected than delivered")

    tx = stored(f"{interim}/transactions_clean")
    cu = stored(f"{interim}/customers_clean")
    joined, finish = join_customers(tx, cu, salted=salted), partial(finish_fact, holidays=holidays)
    counts["fact"] = sinks.save_fact(joined, f"{out}/processed/fct_transactions", finish, sinks.FACT_SLICES)
    # a fact table without rows has no file to take the columns from
    fact = spark.read.schema(finish(joined).schema).parquet(f"{out}/processed/fct_transactions")

    loads: dict[str, int] = {}
    if warehouse:
        try:
            loads = sinks.load_all(cu, tx, fact, f"{out}/warehouse", now, holidays)
        except Exception:  # loading is optional: the run goes on without it
            log.exception("warehouse load skipped")

    quality = run_quality_checks(tx, cu, fact, now, day, invoice_severity)
    anomalies = run_anomaly_detection(fact, now, day, **volume)
    results_path = f"{out}/results/run_date={day}"
    found = validation.unionByName(quality).unionByName(anomalies)
    found.drop("run_date").coalesce(1).write.mode("overwrite").parquet(results_path)
    results = stored(results_path).withColumn("run_date", F.lit(day).cast("date"))
    if loads:
        try:
            history = dq_table(results.where(F.col("stage") == "quality"))
            sinks.replace_dq_results(history, f"{out}/warehouse", day)
        except Exception:  # the history is optional too
            log.exception("check history not written")

    sections = report_tables(
        results,
        counts_table(spark, ingested, "source"),
        counts_table(spark, loads, "table") if loads else None,
    )
    save_report(sections, f"{out}/report", day)
    code = run_verdict(results).first()["status_code"]
    if any(name.endswith("_unfit") for name in loads):  # rows set aside are a finding
        code = max(code, 1)
    return RunResult(int(code), counts | {f"loaded_{t}": n for t, n in loads.items()}, out)
