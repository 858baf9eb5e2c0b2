"""Micro-fixtures: small frames with hand-written expectations."""

from __future__ import annotations

from datetime import datetime, timedelta

TX_SCHEMA = (
    "InvoiceNo string, StockCode string, Description string, Quantity string, InvoiceDate string, "
    "UnitPrice string, CustomerID string, Country string, Status string, PaymentMethod string, _row_id int"
)
CU_SCHEMA = "CustomerID string, Country string, SignupDate string, Segment string, IsActive string, _row_id int"


def dirty_transactions(spark):
    uk = "United Kingdom"
    data = [
        ("I1", "S1", "blue kettle", "5", "2023-01-15 10:00:00", "2.5", "C1", uk, "done", "card", 1),
        ("I2", "S2", "T-LIGHT 3d o'neil", "-2", "2023-02-20", "1.0", "C2", f" {uk} ", " VOID ", "card", 2),
        ("I3", "S3", "OAK SHELF", "10", "not-a-date", "3.0", "C3", uk, "return", "card", 3),
        ("I4", "S4", "Tin lamp", "3", "2023-03-01 09:00:00", "-1.5", "C4", uk, "completed", "card", 4),
        ("I1", "S1", "second copy", "5", "2023-01-15 10:00:00", "2.5", "C1", uk, "completed", "card", 5),
        ("I5", "S5", None, "x", "2099-01-01", None, None, uk, None, "card", 6),
        ("I6", "S6", "free", "1", "2023-04-01", "0", None, "Atlantis", "On Hold", "card", 7),
        (None, "S7", "no invoice", "1", "2023-04-01", "1", None, uk, None, "card", 8),
        (None, "S7", "no invoice again", "1", "2023-04-01", "1", None, uk, None, "card", 9),
    ]
    return spark.createDataFrame(data, TX_SCHEMA)


def dirty_customers(spark):
    data = [
        ("C1", "UNITED KINGDOM", "2020-01-01", "RETAIL", "True", 1),
        ("C2", "germany", "bad-date", "Wholesale", "0", 2),
        (" C3 ", "uk", "2021-05-10", " online ", "1", 3),
        (None, "Italy", "2022-03-01", "retail", "true", 4),
        ("C1", "France", "2019-01-01", "other", "false", 5),
        ("C4", "eire", None, None, "maybe", 6),
    ]
    return spark.createDataFrame(data, CU_SCHEMA)


def holidays(spark):
    data = [
        ("GB", "2023-01-15", "second name", "Z Day", True),
        ("GB", "2023-01-15", "first name", "A Day", True),
        ("DE", "2023-02-20", "Tag", "Tag", True),
        (None, "2023-04-01", "nowhere", "Nowhere Day", True),
    ]
    schema = "country_code string, date string, local_name string, name string, is_global boolean"
    return spark.createDataFrame(data, schema).selectExpr(
        "country_code", "cast(date as date) as date", "local_name", "name", "is_global"
    )


def steady_fact(spark, days: int = 60):
    """One row a day, one in ten cancelled, 20 customers."""
    start = datetime(2023, 1, 1)
    data = [
        (
            f"N{i}",
            f"S{i}",
            f"C{i % 20}",
            4.0 + i % 3,
            2 + i % 6,
            (4.0 + i % 3) * (2 + i % 6),
            start + timedelta(days=i),
            "United Kingdom",
            "cancelled" if i % 10 == 0 else "completed",
        )
        for i in range(days)
    ]
    schema = (
        "InvoiceNo string, StockCode string, CustomerID string, UnitPrice double, Quantity int, LineTotal double, "
        "InvoiceDate timestamp, Country string, Status string"
    )
    return spark.createDataFrame(data, schema)


def steady_customers(spark):
    return spark.createDataFrame([(f"C{i}", "United Kingdom") for i in range(20)], "CustomerID string, Country string")


def volume_spike(spark):
    start = datetime(2023, 1, 1)
    days = [start + timedelta(days=d) for d in range(29) for _ in range(10)]
    days += [start + timedelta(days=29)] * 200
    return spark.createDataFrame([(d,) for d in days], "InvoiceDate timestamp")
