from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veritill import functions as fx


def apply(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    found = df.select("i", expr(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(found, key=lambda r: r["i"])]


TITLES = ["T-LIGHT", "3d", "o'neil", "white  hanging HEART", "", None, "ünter straße", "a1b2", "x_y", "x\ty"]


def test_title_case_follows_python(spark):
    assert apply(spark, TITLES, fx.title_case) == [None if t is None else t.title() for t in TITLES]


def test_capitalise_words_keeps_digits_in_words(spark):
    given_ = ["T-LIGHT", "3d glasses", "o'neil", "a1b2", None]
    assert apply(spark, given_, fx.capitalise_words) == ["T-Light", "3d Glasses", "O'Neil", "A1b2", None]


def test_strip_drops_all_white_space(spark):
    values = ["  a b ", "\ta\n", " a ", "　é　", "   ", "", None, "a", "\x1ca\x1f", "é"]
    assert apply(spark, values, fx.strip) == [None if v is None else v.strip() for v in values]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t  aZ9é-'", max_size=12), min_size=1, max_size=40))
def test_strip_and_title_on_random_text(spark, texts):
    assert apply(spark, texts, fx.strip) == [t.strip() for t in texts]
    assert apply(spark, texts, fx.title_case) == [t.title() for t in texts]


def test_number_reads_decimals_only(spark):
    texts = ["1e3", " 12 ", "inf", "-Infinity", "1d", "2f", "0x1p3", "nan", "NaN", "abc", "", None, "+.5", "5.", "1_0", " 7"]
    expected = [1000.0, 12.0, math.inf, -math.inf, None, None, None, None, None, None, None, None, 0.5, 5.0, None, 7.0]
    assert apply(spark, texts, fx.number) == expected


def test_number_of_doubles_drops_nan(spark):
    got = apply(spark, [1.5, float("nan"), None], lambda c: fx.number(c, text=False), "double")
    assert got == [1.5, None, None]


def test_parse_timestamp_accepts_both_declared_forms(spark):
    texts = ["2023-01-15 10:00:00", "2023-01-15", " 2023-01-15 ", "not-a-date", "2023-13-01", "2023-01-15T10", "12:30", None]
    got = [None if t is None else str(t) for t in apply(spark, texts, fx.parse_timestamp)]
    day = "2023-01-15 00:00:00"
    assert got == ["2023-01-15 10:00:00", day, day, None, None, None, None, None]


def test_tenure_counts_elapsed_days(spark):
    cases = [
        ("2022-06-01 00:00:00", "2023-06-01 00:00:00", 365),
        ("2022-06-01 12:00:00", "2022-06-02 11:59:59", 0),
        ("2023-06-02 00:00:00", "2023-06-01 00:00:00", 0),
        (None, "2023-06-01 00:00:00", None),
    ]
    df = spark.createDataFrame([(a, b, e) for a, b, e in cases], "a string, b string, e int")
    got = df.select(fx.tenure_days(F.col("a").cast("timestamp"), F.col("b").cast("timestamp")).alias("d"), "e")
    assert all(r["d"] == r["e"] for r in got.collect())


def test_status_and_flag(spark):
    statuses = ["complete", " DONE ", "Cancel", "void", "refund", "return", "On Hold", None]
    expected = ["completed", "completed", "cancelled", "cancelled", "refunded", "refunded", "on hold", None]
    assert apply(spark, statuses, fx.normalise_status) == expected
    flags = ["True", "1", "false", "0", "maybe", None, " TRUE "]
    assert apply(spark, flags, fx.flag) == [True, True, False, False, None, None, True]


@pytest.mark.parametrize(("q", "p", "total"), [(1.0, 0.00005, 0.0), (1.0, 0.00015, 0.0002), (-2.0, 1.25, -2.5)])
def test_products_round_ties_to_even(spark, q, p, total):
    df = spark.createDataFrame([(q, p)], "q double, p double")
    assert df.select(fx.rounded_product(F.col("q"), F.col("p"))).first()[0] == pytest.approx(total, abs=1e-12)


def test_texts_of_numbers(spark):
    got = apply(spark, [0.125, 2.5, 0.0], lambda c: fx.decimal_text(c, 2), "double")
    assert got == [f"{v:.2f}" for v in (0.125, 2.5, 0.0)]
    assert apply(spark, [1234567], fx.grouped_text, "long") == ["1,234,567"]
