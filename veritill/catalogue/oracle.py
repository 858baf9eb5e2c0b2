"""SQL building blocks for the checks: the adapters and the cleaned tables as CTEs."""

from __future__ import annotations

from veritill.catalogue.adapters import AS_OF, LINE_ORDER, NATION_NAMES
from veritill.model import COUNTRY_ALIASES, COUNTRY_ISO2, STATUS_SYNONYMS

NOW = f"TIMESTAMP '{AS_OF}'"


def case(expr: str, mapping: dict[str, str], default: str, quote_key: bool = True) -> str:
    quote = (lambda k: f"'{k}'") if quote_key else str
    arms = " ".join(f"WHEN {quote(k)} THEN '{v}'" for k, v in mapping.items())
    return f"CASE {expr} {arms} ELSE {default} END"


def iso2(expr: str) -> str:
    return case(expr, COUNTRY_ISO2, "NULL")


def _runs(expr: str, inner: str) -> str:
    pieces = rf"regexp_extract_all(lower({expr}), '([{inner}]+|[^{inner}]+)')"
    return f"array_to_string([upper(p[1]) || p[2:] FOR p IN {pieces}], '')"


def title(expr: str) -> str:
    """Capital after every non-letter."""
    return _runs(expr, r"\p{L}")


def words(expr: str) -> str:
    """Capital after everything that is neither letter nor digit."""
    return _runs(expr, r"\p{L}\p{N}")


def ts_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def day_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def parse(expr: str) -> str:
    return (
        f"COALESCE(TRY_STRPTIME({expr}, '%Y-%m-%d %H:%M:%S'), TRY_STRPTIME({expr}, '%Y-%m-%d'))"
    )


def flag(expr: str) -> str:
    return f"CASE lower(trim({expr})) WHEN 'true' THEN TRUE WHEN '1' THEN TRUE WHEN 'false' THEN FALSE WHEN '0' THEN FALSE END"


def status(expr: str) -> str:
    return case(f"trim(lower({expr}))", STATUS_SYNONYMS, f"trim(lower({expr}))")


def country(expr: str) -> str:
    return case(title(f"trim({expr})"), COUNTRY_ALIASES, title(f"trim({expr})"))


_LINE_ORDER = ", ".join(LINE_ORDER)

_CTES = {
    "nations": f"""
        SELECT n_nationkey, {case("n_nationkey", NATION_NAMES, "n_name", quote_key=False)} AS country
        FROM nation""",
    "raw_tx": f"""
        SELECT
          CAST(l_orderkey AS VARCHAR) AS "InvoiceNo",
          CAST(l_partkey AS VARCHAR) AS "StockCode",
          CASE l_partkey % 3
            WHEN 0 THEN upper(p_name)
            WHEN 1 THEN '  ' || p_name || ' '
            ELSE replace(p_name, ' ', '-') || ' 3d' END AS "Description",
          CASE WHEN l_orderkey % 101 = 0 THEN 'dozen'
               WHEN l_returnflag = 'R' THEN CAST(-CAST(l_quantity AS INTEGER) AS VARCHAR)
               ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS "Quantity",
          CASE WHEN l_orderkey % 83 = 0 THEN 'not-a-date'
               WHEN l_orderkey % 79 = 0 THEN '2099-01-01'
               WHEN l_linenumber = 7 THEN strftime(l_shipdate, '%Y-%m-%d')
               ELSE strftime(l_shipdate, '%Y-%m-%d') || ' '
                 || lpad(CAST((l_orderkey + 5 * l_linenumber) % 24 AS VARCHAR), 2, '0') || ':15:00'
          END AS "InvoiceDate",
          CASE WHEN l_orderkey % 97 = 0 THEN NULL
               WHEN l_orderkey % 89 = 0 THEN '-1.50'
               ELSE CAST(CAST((CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) * 0.01
                 AS DECIMAL(14, 2)) AS VARCHAR) END AS "UnitPrice",
          CASE WHEN o_custkey % 31 = 0 THEN NULL
               WHEN o_custkey % 29 = 0 THEN 'GHOST' || o_custkey
               WHEN l_linenumber = 3 THEN ' ' || o_custkey || '  '
               ELSE CAST(o_custkey AS VARCHAR) END AS "CustomerID",
          country AS "Country",
          CASE WHEN o_custkey % 23 = 0 THEN 'On Hold'
               WHEN l_orderkey % 11 = 0 THEN NULL
               WHEN l_orderkey % 7 = 0 THEN ' Completed'
               WHEN o_orderstatus = 'O' THEN 'done'
               WHEN o_orderstatus = 'F' THEN 'VOID '
               ELSE 'return' END AS "Status",
          CASE WHEN l_linestatus = 'O' THEN 'card' ELSE ' PayPal' END AS "PaymentMethod",
          {_LINE_ORDER}
        FROM lineitem
        LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nations ON c_nationkey = n_nationkey
        LEFT JOIN part ON l_partkey = p_partkey""",
    "raw_cu": """
        SELECT
          CASE WHEN c_custkey % 53 = 0 THEN NULL
               WHEN c_custkey % 7 = 0 THEN '  ' || c_custkey || ' '
               ELSE CAST(c_custkey AS VARCHAR) END AS "CustomerID",
          CASE WHEN c_custkey % 50 = 1 THEN upper(country)
               WHEN c_custkey % 50 = 2 THEN 'uk'
               WHEN c_custkey % 50 = 3 THEN 'EIRE'
               WHEN copy = 1 THEN lower(country)
               ELSE country END AS "Country",
          CASE WHEN c_custkey % 61 = 0 THEN 'bad-date'
               WHEN c_custkey % 67 = 0 THEN NULL
               ELSE strftime(DATE '1995-01-01' + CAST(c_custkey % 1800 AS INTEGER), '%Y-%m-%d') END AS "SignupDate",
          CASE WHEN c_custkey % 43 = 0 THEN NULL ELSE ' ' || c_mktsegment END AS "Segment",
          CASE WHEN c_custkey % 59 = 0 THEN 'maybe'
               WHEN c_acctbal < 0 THEN 'false'
               WHEN c_custkey % 2 = 0 THEN 'True'
               ELSE '1' END AS "IsActive",
          c_custkey * 2 + copy AS row_id
        FROM (SELECT *, 0 AS copy FROM customer
              UNION ALL SELECT *, 1 AS copy FROM customer WHERE c_custkey % 41 = 0)
        LEFT JOIN nations ON c_nationkey = n_nationkey""",
    "holidays": f"""
        SELECT DISTINCT {iso2("country")} AS country_code,
          CAST(o_orderdate AS DATE) AS date,
          'jour ' || o_orderpriority AS local_name,
          'Day ' || o_orderpriority AS name,
          CASE WHEN o_orderpriority <> '5-LOW' THEN TRUE END AS is_global
        FROM orders
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nations ON c_nationkey = n_nationkey
        WHERE day(o_orderdate) IN (1, 15, 25)""",
    "typed_tx": f"""
        SELECT "InvoiceNo", "StockCode", trim("Description") AS "Description",
          TRY_CAST("Quantity" AS DOUBLE) AS "Quantity",
          {parse('"InvoiceDate"')} AS "InvoiceDate",
          TRY_CAST("UnitPrice" AS DOUBLE) AS "UnitPrice",
          trim("CustomerID") AS "CustomerID", trim("Country") AS "Country",
          trim("Status") AS "Status", trim("PaymentMethod") AS "PaymentMethod",
          {_LINE_ORDER}
        FROM raw_tx""",
    "tagged_tx": f"""
        SELECT *, concat_ws('|',
            CASE WHEN "InvoiceDate" IS NULL THEN 'bad_date' END,
            CASE WHEN "UnitPrice" IS NULL THEN 'bad_unit_price' END,
            CASE WHEN "Quantity" IS NULL THEN 'bad_quantity' END,
            CASE WHEN "UnitPrice" < 0 THEN 'negative_price' END,
            CASE WHEN "InvoiceDate" > {NOW} THEN 'future_date' END) AS "_reject_reason"
        FROM typed_tx""",
    "first_tx": f"""
        SELECT * FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY "InvoiceNo", "StockCode" ORDER BY {_LINE_ORDER}) AS nth
          FROM tagged_tx WHERE "_reject_reason" = '') WHERE nth = 1""",
    "clean_tx": f"""
        SELECT "InvoiceNo", "StockCode", {title('"Description"')} AS "Description",
          "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country",
          {status('"Status"')} AS "Status", "PaymentMethod",
          round_even("Quantity" * "UnitPrice", 4) AS "LineTotal",
          CAST(year("InvoiceDate") AS INTEGER) AS "TxYear", CAST(month("InvoiceDate") AS INTEGER) AS "TxMonth",
          CAST(day("InvoiceDate") AS INTEGER) AS "TxDay", dayname("InvoiceDate") AS "TxDOW"
        FROM first_tx""",
    "typed_cu": f"""
        SELECT trim("CustomerID") AS "CustomerID", {country('"Country"')} AS "Country",
          {parse('"SignupDate"')} AS "SignupDate", trim(lower("Segment")) AS "Segment",
          {flag('"IsActive"')} AS "IsActive", row_id
        FROM raw_cu""",
    "clean_cu": """
        SELECT "CustomerID", "Country", "SignupDate", "Segment", "IsActive" FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY "CustomerID" ORDER BY row_id) AS nth
          FROM typed_cu WHERE "CustomerID" IS NOT NULL) WHERE nth = 1""",
    "holiday_keys": """
        SELECT country_code, date, MIN(name) AS name FROM holidays
        WHERE country_code IS NOT NULL GROUP BY country_code, date""",
    "fact": f"""
        SELECT t.*, c."Country" AS "Customer_Country", c."SignupDate", c."Segment" AS "CustomerSegment",
          c."IsActive" AS "CustomerIsActive", c."CustomerID" IS NOT NULL AS is_known_customer,
          h.name IS NOT NULL AS is_holiday, h.name AS holiday_name,
          CAST(CASE WHEN c."SignupDate" IS NOT NULL THEN
            greatest(0, date_sub('day', c."SignupDate", t."InvoiceDate")) END AS INTEGER) AS customer_tenure_days,
          CAST(weekofyear(t."InvoiceDate") AS INTEGER) AS "TxWeek",
          {iso2('t."Country"')} AS "CountryISO2"
        FROM clean_tx t
        LEFT JOIN clean_cu c ON t."CustomerID" = c."CustomerID"
        LEFT JOIN holiday_keys h ON {iso2('t."Country"')} = h.country_code
          AND CAST(t."InvoiceDate" AS DATE) = h.date""",
}

_NEEDS = {
    "nations": (),
    "raw_tx": ("nations",),
    "raw_cu": ("nations",),
    "holidays": ("nations",),
    "typed_tx": ("raw_tx",),
    "tagged_tx": ("typed_tx",),
    "first_tx": ("tagged_tx",),
    "clean_tx": ("first_tx",),
    "typed_cu": ("raw_cu",),
    "clean_cu": ("typed_cu",),
    "holiday_keys": ("holidays",),
    "fact": ("clean_tx", "clean_cu", "holiday_keys"),
}

#: Columns of the clean and fact tables in portable types.
CLEAN_COLUMNS = f'''"InvoiceNo", "StockCode", "Description", "Quantity", {ts_text('"InvoiceDate"')} AS "InvoiceDate",
  "UnitPrice", "CustomerID", "Country", "Status", "PaymentMethod", "LineTotal", "TxYear", "TxMonth", "TxDay", "TxDOW"'''
CUSTOMER_COLUMNS = f'''"CustomerID", "Country", {ts_text('"SignupDate"')} AS "SignupDate", "Segment",
  CAST("IsActive" AS VARCHAR) AS "IsActive"'''
JOINED_COLUMNS = f'''"Customer_Country", {ts_text('"SignupDate"')} AS "SignupDate", "CustomerSegment",
  CAST("CustomerIsActive" AS VARCHAR) AS "CustomerIsActive", CAST(is_known_customer AS VARCHAR) AS is_known_customer'''
FACT_COLUMNS = f'''{CLEAN_COLUMNS}, {JOINED_COLUMNS}, CAST(is_holiday AS VARCHAR) AS is_holiday, holiday_name,
  customer_tenure_days, "TxWeek", "CountryISO2"'''


def exact_ratio(total: str, n: str, scale: int, digits: int) -> str:
    """``total / n`` rounded half away from zero in whole numbers; ``total`` has ``scale`` decimals."""
    units = f"CAST(({total}) * {10**scale} AS HUGEINT)"
    step = f"({n}) * CAST({10 ** max(scale - digits, 0)} AS HUGEINT)"
    scaled = f"abs({units}) * {10 ** max(digits - scale, 0)}"
    rounded = f"((2 * {scaled} + {step}) // (2 * {step}))"
    return f"CAST(sign({units}) * {rounded} AS DOUBLE) / {10**digits}"


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``body`` after the named CTEs and whatever they build on."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS[name]:
            visit(need)
        if name not in needed:
            needed.append(name)

    for name in names:
        visit(name)
    parts = [f"{name} AS ({_CTES[name]})" for name in needed]
    parts += [f"{name} AS ({sql})" for name, sql in (extra or {}).items()]
    return f"WITH {', '.join(parts)}\n{body}"


def literal(value: str) -> str:
    escaped = value.replace("'", "''")
    return f"'{escaped}'"


def check_row(
    table: str,
    check: str,
    passed: str,
    severity: str,
    message: str,
    rows: str,
    source: str,
    labels: tuple[str, str] = ("PASS", "FAIL"),
) -> str:
    """One check result; severity, message and the rest are SQL expressions."""
    return f"""SELECT '{table}' AS "table", '{check}' AS "check",
      CASE WHEN {passed} THEN '{labels[0]}' ELSE '{labels[1]}' END AS status,
      {severity} AS severity, {message} AS message, CAST({rows} AS BIGINT) AS rows_affected FROM {source}"""


def union(*rows: str) -> str:
    return "\nUNION ALL\n".join(rows)


