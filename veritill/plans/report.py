"""Run verdict and report tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritill.operators.checks import anomaly_table, dq_table, validation_table
from veritill.sources.sinks import in_parallel


def run_verdict(results: DataFrame) -> DataFrame:
    """Failures per stage, the status code and the health verdict of a run.

    The code is 1 for any error-severity validation failure, any quality failure or any
    anomaly.  The verdict is stricter: a validation failure of any severity needs attention.
    """
    failed = ~F.col("passed")

    def failures(stage: str, extra: Column | None = None) -> Column:
        bad = (F.col("stage") == stage) & failed
        return F.count_if(bad if extra is None else bad & extra)

    counted = results.agg(
        F.count(F.lit(1)).alias("checks"),
        failures("validation").alias("validation_failures"),
        failures("validation", F.col("severity") == "error").alias("validation_errors"),
        failures("quality").alias("quality_failures"),
        failures("anomaly").alias("anomalies"),
    )
    serious = F.col("validation_errors") + F.col("quality_failures") + F.col("anomalies")
    any_issue = F.col("validation_failures") + F.col("quality_failures") + F.col("anomalies")
    return counted.select(
        "*",
        F.when(serious > 0, 1).otherwise(0).alias("status_code"),
        F.when(any_issue == 0, "HEALTHY").otherwise("NEEDS ATTENTION").alias("verdict"),
    )


def counts_table(spark: SparkSession, counts: Mapping[str, int], name: str) -> DataFrame:
    """Row counts of a run as a table; ``counts`` has one entry per source or table."""
    return spark.createDataFrame([(k, int(v)) for k, v in counts.items()], f"{name} string, row_count long")


def report_tables(
    results: DataFrame, ingested: DataFrame, loaded: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The sections of a run report, each a table of its own."""
    stage = F.col("stage")
    sections = {
        "ingestion": ingested,
        "validation": validation_table(results.where(stage == "validation")),
        "quality": dq_table(results.where(stage == "quality")),
        "anomalies": anomaly_table(results.where((stage == "anomaly") & ~F.col("passed"))),
        "verdict": run_verdict(results),
    }
    if loaded is not None:
        sections["load"] = loaded
    return sections


def stage_summary(results: DataFrame) -> DataFrame:
    """Checks and failures per stage, as the report's section headings give them."""
    return (
        results.groupBy("stage")
        .agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed")).alias("failures"))
        .orderBy("stage")
    )


def save_report(sections: Mapping[str, DataFrame], folder: str, run_date: str) -> None:
    """Write every section under ``<folder>/<section>/run_date=<day>``."""

    def save(name: str, table: DataFrame) -> None:
        table.drop("run_date").coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}/run_date={run_date}")

    in_parallel(*[partial(save, name, table) for name, table in sections.items()])
