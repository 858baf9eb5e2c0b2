"""Queries over the reporting aggregates and the run report."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritill.catalogue import adapters, anomalies, frames
from veritill.catalogue import quality as dq
from veritill.catalogue import raw_checks as raw
from veritill.catalogue.adapters import AS_OF, RUN_DATE, plain
from veritill.catalogue.oracle import NOW, day_text, exact_ratio, ts_text, union, with_ctes
from veritill.catalogue.registry import query
from veritill.model import HOUR_BINS, WEEKDAYS
from veritill.operators import analytics, cleaning, quality, validation
from veritill.operators.anomalies import CHECKED, run_anomaly_detection
from veritill.plans import report

_REVENUE = 'SUM(CAST("LineTotal" AS DECIMAL(14, 4)))'


def _fact(body: str) -> str:
    return with_ctes(body, "fact")


@query(
    "r01_kpis",
    _fact(
        f"""SELECT COUNT(*) AS tx_rows, CAST(ROUND({_REVENUE}, 2) AS DOUBLE) AS total_revenue,
              COUNT(DISTINCT "CustomerID") AS unique_customers,
              {exact_ratio(_REVENUE, 'COUNT("LineTotal")', 4, 2)} AS avg_order_value,
              round_even(COUNT(*) FILTER (WHERE "Status" = 'cancelled')::DOUBLE / COUNT(*) * 100, 1) AS cancel_pct,
              COUNT(DISTINCT "Country") AS countries,
              {ts_text('MIN("InvoiceDate")')} AS date_min, {ts_text('MAX("InvoiceDate")')} AS date_max,
              round_even(COUNT(*) FILTER (WHERE NOT is_known_customer)::DOUBLE / COUNT(*) * 100, 1) AS guest_pct
            FROM fact"""
    ),
)
def r01(spark, sf):
    return plain(analytics.kpis(frames.numbered_fact(spark, sf)))


@query(
    "r01_kpis_with_rejected",
    with_ctes(
        f"""SELECT COUNT(*) AS tx_rows, CAST(ROUND({_REVENUE}, 2) AS DOUBLE) AS total_revenue,
              (SELECT COUNT(*) FROM tagged_tx WHERE "_reject_reason" <> '') AS rejected_rows FROM fact""",
        "fact",
        "tagged_tx",
    ),
)
def r01_rejected(spark, sf):
    found = analytics.kpis(frames.numbered_fact(spark, sf), frames.numbered_tx(spark, sf).rejected)
    return plain(found.select("tx_rows", "total_revenue", "rejected_rows"))


@query(
    "r03_large_amounts",
    _fact(
        f"""SELECT "Country", CAST({_REVENUE.replace("14, 4", "28, 4")} AS DOUBLE) AS revenue
            FROM (SELECT * REPLACE (CASE WHEN CAST("InvoiceNo" AS BIGINT) % 5 = 0 THEN "LineTotal" * 1e7
                                         ELSE "LineTotal" END AS "LineTotal") FROM fact)
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
    ),
)
def r03_large(spark, sf):
    """Totals far beyond a warehouse column; none drops out of the sums."""
    total = F.when(F.col("InvoiceNo").cast("bigint") % 5 == 0, F.col("LineTotal") * 1e7).otherwise(F.col("LineTotal"))
    return plain(analytics.top_countries_by_revenue(frames.numbered_fact(spark, sf).withColumn("LineTotal", total)))


@query(
    "r02_daily_volume",
    f"""SELECT {day_text("day")} AS day, tx_count, ROUND(rolling_mean, 6) AS rolling7
        FROM ({anomalies.rolling(anomalies.daily("orders", "o_orderdate"), 3, 3)})""",
)
def r02(spark, sf):
    orders = adapters.table(spark, sf, "orders").select(F.col("o_orderdate").alias("InvoiceDate"))
    return plain(analytics.daily_volume(orders).withColumn("rolling7", F.round("rolling7", 6)))


@query(
    "r03_top_countries",
    _fact(f'SELECT "Country", CAST({_REVENUE} AS DOUBLE) AS revenue FROM fact GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10'),
)
def r03(spark, sf):
    return plain(analytics.top_countries_by_revenue(frames.numbered_fact(spark, sf)))


@query(
    "r04_status",
    _fact(
        """SELECT "Status", COUNT(*) AS row_count, ROUND(100.0::DOUBLE * COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS pct
           FROM fact WHERE "Status" IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1"""
    ),
)
def r04(spark, sf):
    return analytics.status_distribution(frames.numbered_fact(spark, sf)).withColumn("pct", F.round("pct", 6))


# --------------------------------------------------------------------------- histograms
def _bins(source: str, column: str, bins: int, where: str = "TRUE", low=None, high=None, extra: str = "") -> str:
    x = f'CAST("{column}" AS DOUBLE)'
    if low is not None:
        x = f"least(greatest({x}, {low}), {high})"
    return f"""SELECT CAST(g.bin AS INTEGER) AS bin, ROUND(r.lo + (r.hi - r.lo) / {bins} * g.bin, 6) AS bin_low,
          ROUND(r.lo + (r.hi - r.lo) / {bins} * (g.bin + 1), 6) AS bin_high,
          COALESCE(c.n, 0) AS row_count {extra}
        FROM range({bins}) g(bin)
        CROSS JOIN (SELECT MIN({x}) AS lo, MAX({x}) AS hi FROM {source} WHERE "{column}" IS NOT NULL AND {where}) r
        LEFT JOIN (
          SELECT least(CAST(floor((x - lo) / ((hi - lo) / {bins})) AS BIGINT), {bins - 1}) AS bin, COUNT(*) AS n
          FROM (SELECT {x} AS x, MIN({x}) OVER () AS lo, MAX({x}) OVER () AS hi
                FROM {source} WHERE "{column}" IS NOT NULL AND {where}) GROUP BY 1) c ON c.bin = g.bin"""


def _rounded(bins):
    return bins.withColumns({c: F.round(c, 6) for c in ("bin_low", "bin_high")})


@query("r05_price_histogram", _fact(_bins("fact", "UnitPrice", 60, '"UnitPrice" > 0')))
def r05(spark, sf):
    prices = frames.clean_tx(spark, sf).select("UnitPrice")  # neither customers nor holidays matter here
    return _rounded(analytics.price_histogram(frames.stored(prices, "prices")))


@query(
    "r05_price_median",
    _fact('SELECT ROUND(QUANTILE_CONT("UnitPrice", 0.5), 6) AS median_price FROM fact WHERE "UnitPrice" > 0'),
)
def r05_median(spark, sf):
    median = analytics.price_median(frames.stored(frames.clean_tx(spark, sf).select("UnitPrice"), "prices"))
    return median.select(F.round("median_price", 6).alias("median_price"))


@query(
    "r06_monthly_revenue",
    _fact(
        f"""SELECT {day_text("date_trunc('month', " + '"InvoiceDate")')} AS month,
              CAST({_REVENUE} AS DOUBLE) AS revenue FROM fact GROUP BY 1 ORDER BY 1"""
    ),
)
def r06(spark, sf):
    return plain(analytics.monthly_revenue(frames.numbered_fact(spark, sf)))


@query(
    "r07_quantity_histograms",
    _fact(
        union(
            _bins("fact", "Quantity", 40, '"Quantity" >= 0', -50, 100, ", 'purchase' AS kind"),
            _bins("fact", "Quantity", 20, '"Quantity" < 0', -50, 100, ", 'return' AS kind"),
        )
    ),
)
def r07(spark, sf):
    return _rounded(analytics.quantity_histograms(frames.stored(frames.clean_tx(spark, sf), "quantities")))


@query(
    "r08_segment_revenue",
    _fact(
        f"""SELECT "CustomerSegment", CAST({_REVENUE} AS DOUBLE) AS total_revenue, COUNT("LineTotal") AS tx_count,
              {exact_ratio(_REVENUE, 'COUNT("LineTotal")', 4, 2)} AS avg_order_value
            FROM fact WHERE "CustomerSegment" IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1"""
    ),
)
def r08(spark, sf):
    return plain(analytics.segment_revenue(frames.numbered_fact(spark, sf)))


_DOW = "CASE isodow " + " ".join(f"WHEN {i + 1} THEN '{d}'" for i, d in enumerate(WEEKDAYS)) + " END"
_GRID = ", ".join(f"""COUNT(*) FILTER (WHERE hour(ts) // 2 = {i}) AS "{b}" """ for i, b in enumerate(HOUR_BINS))


@query(
    "r09_weekday_hours",
    f"""SELECT CAST(isodow AS INTEGER) AS weekday, {_DOW} AS dow, g.* EXCLUDE (isodow) FROM (
          SELECT isodow(ts) AS isodow, {_GRID} FROM events GROUP BY 1) g""",
)
def r09(spark, sf):
    return analytics.weekday_hours(adapters.table(spark, sf, "events"), "ts")


# --------------------------------------------------------------------------- profiles
@query(
    "r11_null_profile",
    with_ctes(
        """SELECT * FROM ("""
        + union(
            *[
                f"""SELECT '{c}' AS "column", ROUND((COUNT(*) - COUNT("{c}"))::DOUBLE / COUNT(*), 6) AS null_rate
                    FROM typed_tx"""
                for c in (
                    "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
                    "CustomerID", "Country", "Status", "PaymentMethod",
                )
            ]
        )
        + """) WHERE null_rate > 0 ORDER BY 2 DESC, 1 LIMIT 15""",
        "typed_tx",
    ),
)
def r11(spark, sf):
    profile = analytics.null_profile(frames.typed_tx(spark, sf).drop("_row_id"))
    return profile.withColumn("null_rate", F.round("null_rate", 6))


@query(
    "r12_duplicates",
    with_ctes(
        """SELECT 'InvoiceNo' AS key, CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS surplus
             FROM (SELECT COUNT(*) AS c FROM raw_tx GROUP BY "InvoiceNo")
           UNION ALL SELECT 'InvoiceNo+StockCode', CAST(COALESCE(SUM(c - 1), 0) AS BIGINT)
             FROM (SELECT COUNT(*) AS c FROM raw_tx GROUP BY "InvoiceNo", "StockCode")
           UNION ALL SELECT 'CustomerID', CAST(COALESCE(SUM(c - 1), 0) AS BIGINT)
             FROM (SELECT COUNT(*) AS c FROM raw_cu GROUP BY "CustomerID")""",
        "raw_tx",
        "raw_cu",
    ),
)
def r12(spark, sf):
    return analytics.duplicate_profile(adapters.raw_transactions(spark, sf), adapters.raw_customers(spark, sf))


def _described(column: str) -> str:
    quartiles = ", ".join(
        f"""ROUND(QUANTILE_CONT("{column}", {q}), 2) AS {n}""" for n, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    )
    return f"""SELECT '{column}' AS "column", COUNT("{column}") AS row_count, ROUND(AVG("{column}"), 2) AS mean,
        ROUND(STDDEV_SAMP("{column}"), 2) AS std, ROUND(MIN("{column}"), 2) AS min, {quartiles},
        ROUND(MAX("{column}"), 2) AS max FROM typed_tx"""


@query("r13_describe", with_ctes(union(_described("UnitPrice"), _described("Quantity")), "typed_tx"))
def r13(spark, sf):
    numbers = frames.typed_tx(spark, sf).select("UnitPrice", "Quantity")
    return analytics.describe(frames.stored(numbers, "numbers"))


@query(
    "r14_clipped_histograms",
    with_ctes(
        union(
            _bins("typed_tx", "UnitPrice", 50, low=0, high=20, extra=""", 'UnitPrice' AS "column" """),
            _bins("typed_tx", "Quantity", 50, low=-20, high=50, extra=""", 'Quantity' AS "column" """),
        ),
        "typed_tx",
    ),
)
def r14(spark, sf):
    numbers = frames.typed_tx(spark, sf).select("UnitPrice", "Quantity")
    return _rounded(analytics.clipped_histograms(frames.stored(numbers, "numbers")))


@query(
    "r15_top_countries_by_count",
    with_ctes(
        'SELECT "Country", COUNT(*) AS row_count FROM raw_tx GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10', "raw_tx"
    ),
)
def r15(spark, sf):
    return analytics.top_countries_by_count(adapters.raw_transactions(spark, sf))


@query(
    "r16_coverage",
    with_ctes(
        f"""SELECT {ts_text('MIN("InvoiceDate")')} AS date_min, {ts_text('MAX("InvoiceDate")')} AS date_max,
              COUNT(*) FILTER (WHERE "InvoiceDate" > {NOW}) AS future_dates,
              COUNT(*) FILTER (WHERE "InvoiceDate" IS NULL) AS null_dates FROM typed_tx""",
        "typed_tx",
    ),
)
def r16(spark, sf):
    return plain(analytics.date_coverage(frames.typed_tx(spark, sf), AS_OF))


_AUDIT = """
    SELECT 'transactions' AS layer, 'raw' AS measure, (SELECT COUNT(*) FROM raw_tx) AS row_count
    UNION ALL SELECT 'transactions', 'clean', (SELECT COUNT(*) FROM clean_tx)
    UNION ALL SELECT 'transactions', 'rejected', (SELECT COUNT(*) FROM tagged_tx WHERE "_reject_reason" <> '')
    UNION ALL SELECT 'transactions', 'duplicate',
      (SELECT COUNT(*) FROM tagged_tx WHERE "_reject_reason" = '') - (SELECT COUNT(*) FROM clean_tx)
    UNION ALL SELECT 'customers', 'raw', (SELECT COUNT(*) FROM raw_cu)
    UNION ALL SELECT 'customers', 'clean', (SELECT COUNT(*) FROM clean_cu)
    UNION ALL SELECT 'customers', 'rejected', (SELECT COUNT(*) FROM raw_cu WHERE "CustomerID" IS NULL)
    UNION ALL SELECT 'customers', 'duplicate', (SELECT COUNT("CustomerID") FROM raw_cu) - (SELECT COUNT(*) FROM clean_cu)
    UNION ALL SELECT 'fact', 'rows', (SELECT COUNT(*) FROM fact)
    UNION ALL SELECT 'fact', 'columns', CAST(25 AS BIGINT)
    UNION ALL SELECT 'fact', 'orphans', (SELECT COUNT(*) FROM fact WHERE NOT is_known_customer)"""


@query("r17_layer_audit", _fact(_AUDIT))
def r17(spark, sf):
    tx = cleaning.transaction_counters(frames.typed_tx(spark, sf), AS_OF)
    cu = cleaning.customer_counters(cleaning.type_customers(adapters.raw_customers(spark, sf)))
    return analytics.layer_audit(tx, cu, frames.numbered_fact(spark, sf))


@query("r18_holiday_count", _fact("SELECT COUNT(*) FILTER (WHERE is_holiday) AS holiday_rows FROM fact"))
def r18(spark, sf):
    return analytics.holiday_count(frames.numbered_fact(spark, sf))


_TYPES = {
    "InvoiceNo": "string", "StockCode": "string", "Description": "string", "Quantity": "double",
    "InvoiceDate": "timestamp", "UnitPrice": "double", "CustomerID": "string", "Country": "string",
    "Status": "string", "PaymentMethod": "string", "LineTotal": "double", "TxYear": "int", "TxMonth": "int",
    "TxDay": "int", "TxDOW": "string",
}


@query(
    "r19_schema_preview",
    with_ctes(
        union(
            *[
                f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS "column", '{t}' AS dtype,
                    COUNT("{c}") AS non_null, COUNT(*) AS row_count FROM clean_tx"""
                for i, (c, t) in enumerate(_TYPES.items())
            ]
        ),
        "clean_tx",
    ),
)
def r19(spark, sf):
    return analytics.schema_preview(frames.clean_tx(spark, sf))


# --------------------------------------------------------------------------- run report
def _results(spark, sf, raw=None):
    """All results of a run over the adapted tables, as one stored table; every check reads stored tables."""
    raw = raw or frames.stored_raw(spark, sf)
    tx, cu, fact = frames.checked_layers(spark, sf, raw, CHECKED)
    found = (
        validation.validate_raw(*raw, AS_OF, RUN_DATE)
        .unionByName(quality.run_quality_checks(tx, cu, fact, AS_OF, RUN_DATE))
        .unionByName(run_anomaly_detection(fact, AS_OF, RUN_DATE))
    )
    return frames.stored(found, "results")


_RAW_SUITE = union(*raw._TX_SUITE, *raw._CU_SUITE)
_ALL = f"""SELECT 'validation' AS stage, status, severity, "check" AS name, "table" FROM ({_RAW_SUITE})
    UNION ALL SELECT 'quality', status, severity, "check", "table" FROM ({dq.SUITE})
    UNION ALL SELECT 'anomaly', label, severity, detector, 'fct_transactions' FROM ({anomalies.SUITE})"""


def _run(body: str) -> str:
    return with_ctes(body, "fact", "raw_cu", extra={"results": _ALL})


@query("r10_check_summary", _run("SELECT stage, status, COUNT(*) AS checks FROM results GROUP BY ALL ORDER BY 1, 2"))
def r10(spark, sf):
    return analytics.check_summary(_results(spark, sf))


_BAD = "status IN ('FAIL', 'ANOMALY')"


@query(
    "r20_verdict",
    _run(
        f"""SELECT *,
              CAST(CASE WHEN validation_errors + quality_failures + anomalies > 0 THEN 1 ELSE 0 END AS INTEGER)
                AS status_code,
              CASE WHEN validation_failures + quality_failures + anomalies = 0 THEN 'HEALTHY'
                ELSE 'NEEDS ATTENTION' END AS verdict
            FROM (SELECT COUNT(*) AS checks,
              COUNT(*) FILTER (WHERE stage = 'validation' AND {_BAD}) AS validation_failures,
              COUNT(*) FILTER (WHERE stage = 'validation' AND {_BAD} AND severity = 'error') AS validation_errors,
              COUNT(*) FILTER (WHERE stage = 'quality' AND {_BAD}) AS quality_failures,
              COUNT(*) FILTER (WHERE stage = 'anomaly' AND {_BAD}) AS anomalies FROM results)"""
    ),
)
def r20(spark, sf):
    return report.run_verdict(_results(spark, sf))


@query(
    "r21_report_tables",
    _run(
        f"""SELECT stage AS section, name AS "check", status, severity FROM results WHERE stage <> 'anomaly' OR {_BAD}
            UNION ALL SELECT 'ingestion', 'transactions', CAST(COUNT(*) AS VARCHAR), NULL FROM raw_tx
            UNION ALL SELECT 'ingestion', 'customers', CAST(COUNT(*) AS VARCHAR), NULL FROM raw_cu"""
    ),
)
def r21(spark, sf):
    """The sections of a report below each other; triggered detectors only."""
    raw = frames.stored_raw(spark, sf)
    counted = [
        df.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("row_count"))
        for name, df in zip(("transactions", "customers"), raw)
    ]
    sections = report.report_tables(_results(spark, sf, raw), counted[0].unionByName(counted[1]))
    checks = [sections[s].select(F.lit(s).alias("section"), "check", "status", "severity") for s in ("validation", "quality")]
    hits = sections["anomalies"].selectExpr("'anomaly' as section", "detector as check", "label as status", "severity")
    rows = sections["ingestion"].selectExpr(
        "'ingestion' as section", "source as check", "cast(row_count as string) as status",
        "cast(null as string) as severity",
    )
    return checks[0].unionByName(checks[1]).unionByName(hits).unionByName(rows)
