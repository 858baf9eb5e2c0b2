"""Queries over the statistical detectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritill.catalogue import adapters, frames
from veritill.catalogue.adapters import AS_OF, RUN_DATE, plain
from veritill.catalogue.oracle import day_text, union, with_ctes
from veritill.catalogue.registry import query
from veritill.operators import anomalies
from veritill.operators.checks import anomaly_table, run_rules


def brief(results):
    """Detector results without the run's stamps; figures to six places."""
    table = anomaly_table(results).drop("run_date", "detected_at")
    return plain(table.withColumn("metric_value", F.round("metric_value", 6)))


def _detector(detector, hit, severity, message, metric, threshold, source) -> str:
    return f"""SELECT '{detector}' AS detector, CASE WHEN {hit} THEN 'ANOMALY' ELSE 'NORMAL' END AS label,
      CAST({hit} AS VARCHAR) AS triggered, {severity} AS severity, {message} AS message,
      ROUND(CAST({metric} AS DOUBLE), 6) AS metric_value, CAST({threshold} AS DOUBLE) AS threshold FROM {source}"""


# --------------------------------------------------------------------------- SQL of the detectors
def daily(source: str, date: str) -> str:
    return f"""SELECT CAST({date} AS DATE) AS day, COUNT(*) AS tx_count FROM {source}
        WHERE {date} IS NOT NULL GROUP BY 1"""


def rolling(series: str, before: int, after: int) -> str:
    frame = f"(ORDER BY day ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING)"
    return f"""SELECT day, tx_count, AVG(tx_count) OVER {frame} AS rolling_mean,
        COALESCE(STDDEV_SAMP(tx_count) OVER {frame}, 1) AS rolling_std,
        (tx_count - AVG(tx_count) OVER {frame})
          / CASE COALESCE(STDDEV_SAMP(tx_count) OVER {frame}, 1) WHEN 0 THEN 1
            ELSE STDDEV_SAMP(tx_count) OVER {frame} END AS z_raw FROM ({series})"""


def _z(series: str, before: int = 6, after: int = 0) -> str:
    return f"SELECT *, COALESCE(z_raw, 0) AS z FROM ({rolling(series, before, after)})"


def volume(series: str, threshold: float) -> str:
    """Triggered days, or one normal row, for a series of at least three days."""
    found = _detector(
        "daily_volume_zscore",
        "TRUE",
        f"CASE WHEN abs(z) > {threshold} * 1.5 THEN 'critical' ELSE 'high' END",
        f"'Date ' || {day_text('day')} || ': volume=' || tx_count || '  z=' || format('{{:.2f}}', z)",
        "tx_count",
        threshold,
        f"({_z(series)}) WHERE abs(z) > {threshold} AND (SELECT COUNT(*) FROM ({series})) >= 3",
    )
    normal = _detector(
        "daily_volume_zscore",
        "FALSE",
        "'low'",
        "'Daily transaction volume within normal range.'",
        "0",
        threshold,
        f"""(SELECT COUNT(*) AS days, COUNT(*) FILTER (WHERE abs(z) > {threshold}) AS hits FROM ({_z(series)}))
            WHERE days >= 3 AND hits = 0""",
    )
    return union(found, normal)


def amounts(source: str, column: str, threshold: float, label: str | None = None) -> str:
    profile = f"""(SELECT COUNT(*) AS n FROM (SELECT {column} AS x, AVG({column}) OVER () AS mu,
        STDDEV_SAMP({column}) OVER () AS sd FROM {source} WHERE {column} IS NOT NULL)
        WHERE sd > 0 AND abs((x - mu) / sd) > {threshold})"""
    name = label or column.strip('"')
    return _detector(
        f"amount_zscore.{name}",
        "n > 0",
        "CASE WHEN n > 50 THEN 'high' ELSE 'medium' END",
        f"""CASE WHEN n > 0 THEN n || ' rows with |z| > {threshold} in {name}.'
            ELSE 'No amount anomalies in {name}.' END""",
        "n",
        threshold,
        profile,
    )


def cancellations(source: str, threshold: float = 0.20) -> str:
    rate = f"""(SELECT COUNT(*) FILTER (WHERE "Status" = 'cancelled')::DOUBLE / greatest(COUNT(*), 1) AS r
        FROM {source})"""
    hit = f"r > {threshold}"
    message = f"""'Cancellation rate: ' || format('{{:.1f}}', r * 100) || '% (threshold: {threshold * 100:.0f}%).'"""
    return _detector(
        "cancellation_spike", hit, f"CASE WHEN {hit} THEN 'high' ELSE 'low' END", message,
        "round_even(r, 4)", threshold, rate,
    )


def null_spike(source: str, column: str, threshold: float = 0.05) -> str:
    rate = f"""(SELECT (COUNT(*) - COUNT("{column}"))::DOUBLE / greatest(COUNT(*), 1) AS r FROM {source})"""
    hit = f"r > {threshold}"
    message = f"'Null rate in {column}: ' || format('{{:.2f}}', r * 100) || '%.'"
    return _detector(
        f"null_rate_spike.{column}", hit, f"CASE WHEN {hit} THEN 'high' ELSE 'low' END", message,
        "round_even(r, 4)", threshold, rate,
    )


_WATCHED = ("CustomerID", "InvoiceDate", "UnitPrice")
_ORDERS = daily("orders", "o_orderdate")
SUITE = union(
    volume(daily("fact", '"InvoiceDate"'), 3.0),
    amounts("fact", '"UnitPrice"', 4.0),
    cancellations("fact"),
    *[null_spike("fact", c) for c in _WATCHED],
)


# --------------------------------------------------------------------------- queries
@query(
    "a01_zscore",
    """SELECT event_id, ROUND((value - AVG(value) OVER ()) / STDDEV_SAMP(value) OVER (), 6) AS z_score FROM events""",
)
def a01(spark, sf):
    events = adapters.table(spark, sf, "events")
    return anomalies.zscore(events, "value").select("event_id", F.round("z_score", 6).alias("z_score"))


@query("a02_daily_volume", volume(_ORDERS, 2.0))
def a02(spark, sf):
    """At threshold 2, as a week's frame cannot reach the default of 3."""
    orders = adapters.table(spark, sf, "orders")
    return brief(anomalies.detect_daily_volume(orders, AS_OF, date_col="o_orderdate", z_threshold=2.0))


@query("a02_daily_volume_normal", volume(_ORDERS, 3.0))
def a02_normal(spark, sf):
    orders = adapters.table(spark, sf, "orders")
    return brief(anomalies.detect_daily_volume(orders, AS_OF, date_col="o_orderdate"))


@query(
    "a02_daily_volume_before",
    f"""WITH s AS ({_ORDERS}), w AS (SELECT day, tx_count,
          AVG(tx_count) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS m,
          COALESCE(STDDEV_SAMP(tx_count) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 1) AS sd FROM s)
        SELECT {day_text("day")} AS day, tx_count, ROUND(m, 6) AS rolling_mean, ROUND(sd, 6) AS rolling_std,
          ROUND((tx_count - m) / CASE sd WHEN 0 THEN 1 ELSE sd END, 6) AS z_score FROM w""",
)
def a02_before(spark, sf):
    """Each day against the seven days before it."""
    series = anomalies.daily_counts(adapters.table(spark, sf, "orders"), "o_orderdate")
    scored = anomalies.trailing_z(series, include_current=False)
    figures = ("rolling_mean", "rolling_std", "z_score")
    return plain(scored.withColumns({c: F.round(c, 6) for c in figures}))


@query("a03_amount", union(amounts("events", "value", 4.0), amounts("orders", "o_totalprice", 4.0)))
def a03(spark, sf):
    events, orders = adapters.table(spark, sf, "events"), adapters.table(spark, sf, "orders")
    found = anomalies.detect_amounts(events, AS_OF, column="value")
    return brief(found.unionByName(anomalies.detect_amounts(orders, AS_OF, column="o_totalprice")))


@query("a04_cancellation", with_ctes(cancellations("clean_tx"), "clean_tx"))
def a04(spark, sf):
    tx = frames.clean_tx(spark, sf)
    return brief(run_rules(tx, [anomalies.cancellation_spike(tx)], anomalies.STAGE, AS_OF))


@query(
    "a05_null_spike",
    with_ctes(union(*[null_spike("clean_tx", c) for c in ("CustomerID", "Status", "UnitPrice")]), "clean_tx"),
)
def a05(spark, sf):
    tx = frames.clean_tx(spark, sf)
    rules = anomalies.null_rate_spikes(tx, ["CustomerID", "Status", "UnitPrice", "NotDelivered"])
    return brief(anomalies.detect_rates(tx, rules, AS_OF))


@query("a06_suite", with_ctes(SUITE, "fact"))
def a06(spark, sf):
    fact = frames.stored_fact(spark, sf)
    return brief(anomalies.run_anomaly_detection(fact, AS_OF))


@query(
    "a07_result_table",
    with_ctes(
        f"SELECT '{RUN_DATE}' AS run_date, *, '{AS_OF}' AS detected_at FROM ({SUITE})",
        "fact",
    ),
)
def a07(spark, sf):
    fact = frames.stored_fact(spark, sf)
    results = anomaly_table(anomalies.run_anomaly_detection(fact, AS_OF, RUN_DATE))
    return plain(results.withColumn("metric_value", F.round("metric_value", 6)))


_BAND = ("rolling_mean", "rolling_std", "z_score", "lower_band", "upper_band")


@query(
    "a08_centred_band",
    f"""SELECT {day_text("day")} AS day, tx_count, ROUND(rolling_mean, 6) AS rolling_mean,
          ROUND(rolling_std, 6) AS rolling_std, ROUND(z, 6) AS z_score,
          ROUND(rolling_mean - 3 * rolling_std, 6) AS lower_band,
          ROUND(rolling_mean + 3 * rolling_std, 6) AS upper_band, CAST(abs(z) > 3 AS VARCHAR) AS flagged
        FROM ({_z(_ORDERS, 3, 3)})""",
)
def a08(spark, sf):
    band = anomalies.centred_band(adapters.table(spark, sf, "orders"), "o_orderdate")
    return plain(band.withColumns({c: F.round(c, 6) for c in _BAND}))


def _summary_row(detector: str, figure: str, limit: float, source: str) -> str:
    return f"""SELECT '{detector}' AS detector, CAST({figure} AS DOUBLE) AS figure, CAST({limit} AS DOUBLE) AS limit_value,
      CASE WHEN {figure} > {limit} THEN 'ANOMALY' ELSE 'NORMAL' END AS status FROM {source}"""


_SUMMARY = union(
    _summary_row("daily_volume_zscore", "round_even(MAX(abs(z)), 2)", 3.0, f"""({_z(daily("fact", '"InvoiceDate"'))})"""),
    _summary_row(
        "amount_zscore.UnitPrice",
        "COUNT(*)",
        0,
        """(SELECT "UnitPrice" AS x, AVG("UnitPrice") OVER () AS mu, STDDEV_SAMP("UnitPrice") OVER () AS sd
            FROM fact WHERE "UnitPrice" IS NOT NULL) WHERE sd > 0 AND abs((x - mu) / sd) > 4""",
    ),
    _summary_row(
        "cancellation_spike",
        """round_even(COUNT(*) FILTER (WHERE "Status" = 'cancelled')::DOUBLE / COUNT(*) * 100, 1)""",
        20,
        "fact",
    ),
    *[
        _summary_row(
            f"null_rate_spike.{c}", f"""round_even((COUNT(*) - COUNT("{c}"))::DOUBLE / COUNT(*) * 100, 1)""", 5, "fact"
        )
        for c in _WATCHED
    ],
)


@query("a09_summary", with_ctes(_SUMMARY, "fact"))
def a09(spark, sf):
    fact = frames.stored_fact(spark, sf)
    return anomalies.anomaly_summary(fact).withColumnRenamed("limit", "limit_value")
