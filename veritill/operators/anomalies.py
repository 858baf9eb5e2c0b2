"""Statistical detectors.

Windows only ever run over the daily series, which has one row per calendar day; statistics of
raw rows are one-row aggregates read back through a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from veritill.functions import decimal_text, number, rate
from veritill.model import (
    AMOUNT_HIGH_OUTLIERS,
    AMOUNT_Z_THRESHOLD,
    CANCELLATION_THRESHOLD,
    NULL_RATE_THRESHOLD,
    VOLUME_WINDOW,
    VOLUME_Z_THRESHOLD,
)
from veritill.operators.checks import Rule, Verdict, result_struct, run_rules, union_results
from veritill.operators.validation import counted

STAGE = "anomaly"
LABELS = ("NORMAL", "ANOMALY")
TABLE = "fct_transactions"
#: Every column that the detectors of a run read.
CHECKED = ("InvoiceDate", "UnitPrice", "Status", "CustomerID")


# --------------------------------------------------------------------------- z-scores
def _amount(df: DataFrame, column: str) -> Column:
    return number(F.col(column), text=isinstance(df.schema[column].dataType, T.StringType))


def _moments(value: Column) -> Column:
    return F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def _z(value: Column, mean: Column, std: Column) -> Column:
    """Zero where the deviation is zero or undefined."""
    return F.when(value.isNotNull(), F.coalesce((value - mean) / F.nullif(std, F.lit(0.0)), F.lit(0.0)))


def zscore(df: DataFrame, column: str, into: str = "z_score") -> DataFrame:
    """A1: sample z-score of a numeric column; null amounts have none."""
    value = _amount(df, column)
    moments = df.agg(_moments(value).alias("m")).scalar()
    scored = df.withColumn("_m", moments)
    return scored.withColumn(into, _z(value, F.col("_m.mean"), F.col("_m.std"))).drop("_m")


# --------------------------------------------------------------------------- daily volume
def daily_counts(df: DataFrame, date_col: str = "InvoiceDate", fill_gaps: bool = False) -> DataFrame:
    """Rows per calendar day; ``fill_gaps`` adds the days without any."""
    daily = (
        df.where(F.col(date_col).isNotNull())
        .groupBy(F.to_date(date_col).alias("day"))
        .agg(F.count(F.lit(1)).alias("tx_count"))
    )
    if not fill_gaps:
        return daily
    calendar = daily.select(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    return calendar.join(daily, "day", "left").na.fill(0, ["tx_count"])


def rolling_z(daily: DataFrame, before: int, after: int) -> DataFrame:
    """Mean, deviation and z-score of every day in a frame of neighbouring observed days."""
    frame = Window.orderBy("day").rowsBetween(-before, after)
    std = F.coalesce(F.stddev_samp("tx_count").over(frame), F.lit(1.0))
    return daily.select(
        "day", "tx_count", F.avg("tx_count").over(frame).alias("rolling_mean"), std.alias("rolling_std")
    ).withColumn("z_score", _unit_z())


def _unit_z() -> Column:
    unit = F.when(F.col("rolling_std") == 0, F.lit(1.0)).otherwise(F.col("rolling_std"))
    return (F.col("tx_count") - F.col("rolling_mean")) / unit


def trailing_z(daily: DataFrame, window: int = VOLUME_WINDOW, include_current: bool = True) -> DataFrame:
    """Trailing frame of ``window`` observed days.

    With the current day inside its own frame |z| stays below ``(w-1)/sqrt(w)``, 2.27 for a
    week; ``include_current=False`` measures the day against the days before it.
    """
    return rolling_z(daily, window - 1, 0) if include_current else rolling_z(daily, window, -1)


def detect_daily_volume(
    df: DataFrame,
    as_of,
    run_date=None,
    date_col: str = "InvoiceDate",
    z_threshold: float = VOLUME_Z_THRESHOLD,
    window: int = VOLUME_WINDOW,
    include_current: bool = True,
    fill_gaps: bool = False,
    position: int = 0,
) -> DataFrame:
    """A2: one row per unusual day, or one normal row; nothing below three days."""
    series = trailing_z(daily_counts(df, date_col, fill_gaps), window, include_current)
    hit = F.coalesce(F.abs("z_score") > z_threshold, F.lit(False))
    whole = Window.partitionBy()
    judged = series.select(
        "*",
        hit.alias("hit"),
        F.count(F.lit(1)).over(whole).alias("days"),
        F.count_if(hit).over(whole).alias("hits"),
        F.row_number().over(Window.orderBy("day")).alias("nth"),
    ).where((F.col("days") >= 3) & (F.col("hit") | ((F.col("hits") == 0) & (F.col("nth") == 1))))

    found = F.col("hit")
    size = F.abs("z_score")
    message = F.concat(
        F.lit("Date "), F.col("day").cast("string"),
        F.lit(": volume="), F.col("tx_count").cast("string"),
        F.lit("  z="), decimal_text(F.col("z_score"), 2),
    )
    verdict = Verdict(
        passed=~found,
        severity=F.when(~found, "low").when(size > z_threshold * 1.5, "critical").otherwise("high"),
        message=F.when(found, message).otherwise("Daily transaction volume within normal range."),
        metric=F.when(found, F.col("tx_count").cast("double")).otherwise(0.0),
        threshold=float(z_threshold),
        details={
            "date": F.when(found, F.col("day").cast("string")),
            "z_score": F.when(found, F.bround("z_score", 3)),
            "tx_count": F.when(found, F.col("tx_count")),
            "rolling_mean": F.when(found, F.bround("rolling_mean", 1)),
        },
    )
    rule = Rule("daily_volume_zscore", TABLE, lambda n, m: verdict, labels=LABELS)
    row = result_struct(position, STAGE, rule, verdict, run_date, as_of)
    return judged.select(row.alias("r")).select("r.*")


# --------------------------------------------------------------------------- amounts
def amount_profile(df: DataFrame, column: str, z_threshold: float) -> DataFrame:
    """One row: amounts, their moments and maximum, and how many lie beyond the threshold."""
    value = _amount(df, column)
    amounts = df.select(value.alias("amount")).where(F.col("amount").isNotNull())
    moments = amounts.agg(_moments(F.col("amount")).alias("m")).scalar()
    z = _z(F.col("amount"), F.col("m.mean"), F.col("m.std"))
    return amounts.select("amount", moments.alias("m")).agg(
        F.count_if(F.abs(z) > z_threshold).alias("outliers"),
        F.avg("amount").alias("mean"),
        F.stddev_samp("amount").alias("std"),
        F.max("amount").alias("max_value"),
    )


def detect_amounts(
    df: DataFrame,
    as_of,
    run_date=None,
    column: str = "UnitPrice",
    z_threshold: float = AMOUNT_Z_THRESHOLD,
    position: int = 0,
) -> DataFrame:
    """A3: rows whose amount is more than ``z_threshold`` deviations from the mean."""
    n = F.col("outliers")
    verdict = Verdict(
        passed=n == 0,
        severity=F.when(n > AMOUNT_HIGH_OUTLIERS, "high").otherwise("medium"),
        message=F.when(n > 0, counted(n, f" rows with |z| > {z_threshold} in {column}.")).otherwise(
            f"No amount anomalies in {column}."
        ),
        rows=n,
        metric=n,
        threshold=float(z_threshold),
        details={
            "outlier_count": n,
            "mean": F.bround("mean", 4),
            "std": F.bround("std", 4),
            "max_value": F.bround("max_value", 4),
        },
    )
    rule = Rule(f"amount_zscore.{column}", TABLE, lambda _n, _m: verdict, labels=LABELS)
    row = result_struct(position, STAGE, rule, verdict, run_date, as_of)
    return amount_profile(df, column, z_threshold).select(row.alias("r")).select("r.*")


# --------------------------------------------------------------------------- rates
def cancellation_spike(
    df: DataFrame,
    column: str = "Status",
    cancel_value: str = "cancelled",
    threshold: float = CANCELLATION_THRESHOLD,
) -> Rule:
    """A4: share of cancelled rows among all rows."""
    if column not in df.columns:
        missing = Verdict(True, "low", f"Column {column} not found — skipped.", metric=0.0, threshold=0.0)
        return Rule("cancellation_spike", TABLE, lambda n, m: missing, labels=LABELS)

    def judge(n, m):
        share = rate(m["cancelled"], n)
        high = share > threshold
        message = F.concat(
            F.lit("Cancellation rate: "),
            decimal_text(share * 100, 1),
            F.lit("% (threshold: "),
            decimal_text(F.lit(threshold * 100), 0),
            F.lit("%)."),
        )
        return Verdict(
            ~high,
            F.when(high, "high").otherwise("low"),
            message,
            rows=m["cancelled"],
            metric=F.bround(share, 4),
            threshold=threshold,
            details={"cancelled": m["cancelled"], "total": F.greatest(n, F.lit(1))},
        )

    measures = {"cancelled": F.count_if(F.col(column) == cancel_value)}
    return Rule("cancellation_spike", TABLE, judge, measures, labels=LABELS)


def null_rate_spikes(df: DataFrame, columns: Sequence[str], threshold: float = NULL_RATE_THRESHOLD) -> list[Rule]:
    """A5: one rule per delivered column."""

    def rule(column: str) -> Rule:
        def judge(n, m):
            share = rate(m["nulls"], n)
            high = share > threshold
            message = F.concat(F.lit(f"Null rate in {column}: "), decimal_text(share * 100, 2), F.lit("%."))
            return Verdict(
                ~high,
                F.when(high, "high").otherwise("low"),
                message,
                rows=m["nulls"],
                metric=F.bround(share, 4),
                threshold=float(threshold),
            )

        measures = {"nulls": F.count_if(F.col(column).isNull())}
        return Rule(f"null_rate_spike.{column}", TABLE, judge, measures, labels=LABELS)

    return [rule(c) for c in columns if c in df.columns]


def detect_rates(df: DataFrame, rules: Sequence[Rule], as_of, run_date=None, position: int = 0) -> DataFrame:
    """A4 and A5 together: one scan."""
    return run_rules(df, rules, STAGE, as_of, run_date, position)


def run_anomaly_detection(
    fact: DataFrame,
    as_of,
    run_date=None,
    z_threshold: float = VOLUME_Z_THRESHOLD,
    window: int = VOLUME_WINDOW,
    include_current: bool = True,
) -> DataFrame:
    """Volume, amounts, cancellations and null rates."""
    parts = []
    if "InvoiceDate" in fact.columns:
        parts.append(
            detect_daily_volume(
                fact, as_of, run_date, z_threshold=z_threshold, window=window, include_current=include_current
            )
        )
    if "UnitPrice" in fact.columns:
        parts.append(detect_amounts(fact, as_of, run_date, position=1))
    rules = [cancellation_spike(fact), *null_rate_spikes(fact, ["CustomerID", "InvoiceDate", "UnitPrice"])]
    parts.append(detect_rates(fact, rules, as_of, run_date, position=2))
    return union_results(parts)


# --------------------------------------------------------------------------- reporting forms
def centred_band(df: DataFrame, date_col: str = "InvoiceDate", window: int = 7, width: float = 3.0) -> DataFrame:
    """Centred rolling mean, deviation, band and z-score per day, with flagged days."""
    half = window // 2
    series = rolling_z(daily_counts(df, date_col), half, half)
    return series.withColumns(
        {
            "lower_band": F.col("rolling_mean") - width * F.col("rolling_std"),
            "upper_band": F.col("rolling_mean") + width * F.col("rolling_std"),
            "flagged": F.abs("z_score") > width,
        }
    )


def anomaly_summary(fact: DataFrame) -> DataFrame:
    """The dashboard's detectors, which compare **rounded** figures with their limits."""
    volume = (
        trailing_z(daily_counts(fact))
        .agg(F.count(F.lit(1)).alias("days"), F.bround(F.max(F.abs("z_score")), 2).alias("figure"))
        .where(F.col("days") >= 3)
        .select(F.lit("daily_volume_zscore").alias("detector"), "figure", F.lit(VOLUME_Z_THRESHOLD).alias("limit"))
    )
    amounts = amount_profile(fact, "UnitPrice", AMOUNT_Z_THRESHOLD).select(
        F.lit("amount_zscore.UnitPrice").alias("detector"),
        F.col("outliers").cast("double").alias("figure"),
        F.lit(0.0).alias("limit"),
    )
    n = F.count(F.lit(1))

    def pct(part: Column) -> Column:
        return F.bround(rate(part, n) * 100, 1)

    watched = ("CustomerID", "InvoiceDate", "UnitPrice")
    rates = fact.agg(
        pct(F.count_if(F.col("Status") == "cancelled")).alias("cancelled"),
        *[pct(F.count_if(F.col(c).isNull())).alias(f"null_{c}") for c in watched],
    )
    rows = [("cancellation_spike", "cancelled", CANCELLATION_THRESHOLD * 100)]
    rows += [(f"null_rate_spike.{c}", f"null_{c}", NULL_RATE_THRESHOLD * 100) for c in watched]
    shares = rates.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("detector"),
                        F.col(column).alias("figure"),
                        F.lit(float(limit)).alias("limit"),
                    )
                    for name, column, limit in rows
                ]
            )
        )
    )
    figures = volume.unionByName(amounts).unionByName(shares)
    return figures.withColumn(
        "status", F.when(F.col("figure") > F.col("limit"), "ANOMALY").otherwise("NORMAL")
    )
