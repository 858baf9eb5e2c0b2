"""Data model: table schemas, column contracts and the fixed values of the business rules."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------- fixed values
# Status synonyms folded by C14.
STATUS_SYNONYMS = {
    "complete": "completed",
    "done": "completed",
    "cancel": "cancelled",
    "void": "cancelled",
    "refund": "refunded",
    "return": "refunded",
}

# Statuses accepted by Q5 and Q16.
VALID_STATUSES = ("completed", "cancelled", "refunded")

# Country aliases folded by C18, keyed by their title-cased form.
COUNTRY_ALIASES = {
    "Uk": "United Kingdom",
    "Usa": "United States",
    "Us": "United States",
    "Eire": "Ireland",
}

# Country name to ISO 3166 alpha-2 code.
COUNTRY_ISO2 = {
    "United Kingdom": "GB",
    "Germany": "DE",
    "France": "FR",
    "Netherlands": "NL",
    "Australia": "AU",
    "Spain": "ES",
    "Switzerland": "CH",
    "Belgium": "BE",
    "Portugal": "PT",
    "Norway": "NO",
    "Italy": "IT",
    "Denmark": "DK",
    "Sweden": "SE",
    "Finland": "FI",
    "Austria": "AT",
    "United States": "US",
    "Japan": "JP",
    "Canada": "CA",
    "Singapore": "SG",
    "Brazil": "BR",
    "Ireland": "IE",
}

# Column contracts of the two raw exports (V2, V3).
REQUIRED_COLUMNS = {
    "transactions": ("InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "UnitPrice", "Country"),
    "customers": ("CustomerID", "Country"),
}
OPTIONAL_COLUMNS = {
    "transactions": ("CustomerID", "Description", "Status", "PaymentMethod"),
    "customers": ("SignupDate", "Segment", "IsActive"),
}

# Default thresholds of the checks and detectors.
NULL_RATE_THRESHOLD = 0.05
NULL_RATE_ERROR = 0.10
MIN_CUSTOMERS = 100
MIN_TRANSACTIONS = 500
VOLUME_Z_THRESHOLD = 3.0
VOLUME_WINDOW = 7
AMOUNT_Z_THRESHOLD = 4.0
AMOUNT_HIGH_OUTLIERS = 50
CANCELLATION_THRESHOLD = 0.20

# Countries whose holiday calendars a run reads by default.
HOLIDAY_COUNTRIES = ("GB", "DE", "FR", "US")

# Shape of the timestamps in the exports, the time of day optional.
DATE_SHAPE = "[0-9]{4}-[0-9]{2}-[0-9]{2}(?: [0-9]{2}:[0-9]{2}:[0-9]{2})?+"

# Weekday order and two-hour bins of the heat map.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
HOUR_BINS = tuple(f"{h:02d}:00" for h in range(0, 24, 2))

# --------------------------------------------------------------------------- row identity
#: Column that carries the position of a row in its source; keep-first rules order by it.
ROW_ID = "_row_id"
REJECT_REASON = "_reject_reason"
LOADED_AT = "_loaded_at"

TRANSACTION_KEY = ("InvoiceNo", "StockCode")
CUSTOMER_KEY = ("CustomerID",)


# --------------------------------------------------------------------------- table schemas
def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_S, _TS, _B = T.StringType(), T.TimestampType(), T.BooleanType()
_I, _SH = T.IntegerType(), T.ShortType()

STG_CUSTOMERS = _schema(CustomerID=_S, Country=_S, SignupDate=_TS, Segment=_S, IsActive=_B)

STG_TRANSACTIONS = _schema(
    InvoiceNo=_S,
    StockCode=_S,
    Description=_S,
    Quantity=_I,
    InvoiceDate=_TS,
    UnitPrice=T.DecimalType(12, 4),
    CustomerID=_S,
    Country=_S,
    Status=_S,
    PaymentMethod=_S,
    LineTotal=T.DecimalType(14, 4),
    TxYear=_SH,
    TxMonth=_SH,
    TxDay=_SH,
    TxDOW=_S,
)

FCT_TRANSACTIONS = T.StructType(
    STG_TRANSACTIONS.fields
    + _schema(
        TxWeek=_SH,
        Customer_Country=_S,
        SignupDate=_TS,
        CustomerSegment=_S,
        CustomerIsActive=_B,
        is_known_customer=_B,
        is_holiday=_B,
        holiday_name=_S,
        customer_tenure_days=_I,
        CountryISO2=_S,
    ).fields
)

DIM_HOLIDAYS = _schema(country_code=_S, date=T.DateType(), local_name=_S, name=_S, is_global=_B)

#: One result row of any check or detector, whatever stage produced it.
RESULTS = _schema(
    run_date=T.DateType(),
    stage=_S,
    position=_I,
    table=_S,
    check=_S,
    status=_S,
    passed=_B,
    severity=_S,
    message=_S,
    rows_affected=T.LongType(),
    metric_value=T.DoubleType(),
    threshold=T.DoubleType(),
    details=T.MapType(_S, _S),
    checked_at=_TS,
)

#: The append-only history table written by K7.
DQ_RESULTS = _schema(
    run_date=T.DateType(),
    table=_S,
    check=_S,
    status=_S,
    severity=_S,
    message=_S,
    rows_affected=T.LongType(),
    checked_at=_TS,
)

TABLE_SCHEMAS = {
    "stg_customers": STG_CUSTOMERS,
    "stg_transactions": STG_TRANSACTIONS,
    "fct_transactions": FCT_TRANSACTIONS,
    "dim_holidays": DIM_HOLIDAYS,
    "dq_results": DQ_RESULTS,
}
