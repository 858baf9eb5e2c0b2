from __future__ import annotations

import pytest
from fixtures import steady_fact, volume_spike
from pyspark.sql import functions as F

from veritill.operators import anomalies
from veritill.operators.checks import run_rules


@pytest.fixture()
def detect(as_of, rows):
    return lambda df, *rules: {r["check"]: r for r in rows(run_rules(df, list(rules), anomalies.STAGE, as_of))}


def test_steady_volume_is_normal(spark, as_of, rows):
    found = rows(anomalies.detect_daily_volume(steady_fact(spark), as_of))
    assert [(r["status"], r["severity"], r["metric_value"]) for r in found] == [("NORMAL", "low", 0.0)]


def test_spike_triggers_at_two(spark, as_of, rows):
    found = rows(anomalies.detect_daily_volume(volume_spike(spark), as_of, z_threshold=2.0))
    assert len(found) == 1
    spike = found[0]
    assert (spike["status"], spike["severity"], spike["metric_value"]) == ("ANOMALY", "high", 200.0)
    assert spike["message"] == "Date 2023-01-30: volume=200  z=2.27"
    assert spike["details"]["z_score"] == "2.268"


def test_default_threshold_needs_the_days_before(spark, as_of, rows):
    normal = rows(anomalies.detect_daily_volume(volume_spike(spark), as_of))
    assert [r["passed"] for r in normal] == [True]
    before = rows(anomalies.detect_daily_volume(volume_spike(spark), as_of, include_current=False))
    assert [r["severity"] for r in before] == ["critical"]


def test_under_three_days_there_is_no_result(spark, as_of):
    two = steady_fact(spark, 2)
    assert anomalies.detect_daily_volume(two, as_of).count() == 0
    assert anomalies.detect_daily_volume(two.where("false"), as_of).count() == 0


def test_gaps_can_be_filled(spark, rows):
    df = spark.createDataFrame([("2023-01-01",), ("2023-01-04",)], "d string").select(
        F.col("d").cast("timestamp").alias("InvoiceDate")
    )
    daily = rows(anomalies.daily_counts(df, fill_gaps=True), "day")
    assert [r["tx_count"] for r in daily] == [1, 0, 0, 1]


def test_amounts(spark, as_of, rows):
    flat = spark.createDataFrame([(2.5,)] * 100, "UnitPrice double")
    spiked = flat.limit(99).unionByName(spark.createDataFrame([(9999.99,)], "UnitPrice double"))
    assert rows(anomalies.detect_amounts(flat, as_of, z_threshold=3.0))[0]["passed"]
    hit = rows(anomalies.detect_amounts(spiked, as_of, z_threshold=3.0))[0]
    assert (hit["status"], hit["metric_value"], hit["severity"]) == ("ANOMALY", 1.0, "medium")
    assert hit["message"] == "1 rows with |z| > 3.0 in UnitPrice."
    text = spark.createDataFrame([("1",), ("x",), (None,), ("3",)], "UnitPrice string")
    assert rows(anomalies.detect_amounts(text, as_of))[0]["details"]["mean"] == "2.0"


def test_zscore_of_a_constant_is_zero(spark, rows):
    df = spark.createDataFrame([(1.0,), (1.0,), (None,)], "v double")
    assert sorted(str(r["z_score"]) for r in rows(anomalies.zscore(df, "v"))) == ["0.0", "0.0", "None"]


@pytest.mark.parametrize(("cancelled", "threshold", "hit"), [(5, 0.10, False), (40, 0.20, True), (20, 0.20, False)])
def test_cancellations(spark, detect, cancelled, threshold, hit):
    data = [("cancelled",)] * cancelled + [("completed",)] * (100 - cancelled)
    df = spark.createDataFrame(data, "Status string")
    found = detect(df, anomalies.cancellation_spike(df, threshold=threshold))["cancellation_spike"]
    assert found["passed"] is not hit and found["metric_value"] == cancelled / 100


def test_cancellations_without_status(spark, detect):
    df = spark.createDataFrame([(1,)], "x int")
    assert detect(df, anomalies.cancellation_spike(df))["cancellation_spike"]["severity"] == "low"


def test_null_spikes(spark, detect):
    df = spark.createDataFrame([(None,)] * 50 + [("C1",)] * 50, "CustomerID string")
    found = detect(df, *anomalies.null_rate_spikes(df, ["CustomerID", "Absent"]))
    assert list(found) == ["null_rate_spike.CustomerID"] and not found["null_rate_spike.CustomerID"]["passed"]


def test_suite_and_summary(spark, as_of, rows):
    results = anomalies.run_anomaly_detection(steady_fact(spark), as_of)
    assert len(rows(results)) == 6 and all(r["passed"] for r in rows(results))
    summary = rows(anomalies.anomaly_summary(steady_fact(spark)))
    assert len(summary) == 6 and {r["status"] for r in summary} == {"NORMAL"}


def test_centred_band(spark, rows):
    band = rows(anomalies.centred_band(volume_spike(spark)), "day")
    assert band[-1]["rolling_mean"] == (10 * 3 + 200) / 4 and not any(r["flagged"] for r in band)
