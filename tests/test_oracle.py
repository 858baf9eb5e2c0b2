"""Registered queries against their SQL on the smallest tables.

By default a selection that touches every operator module; all of them with ORACLE_ALL=1.
"""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from oracle import connect, differences

import __spark_entry__ as entry
from veritill.catalogue import oracles, registered

SF = "/root/testdata/sf0.001"

SELECTION = (
    "a02_daily_volume", "a06_suite", "a08_centred_band", "c10_quarantine", "c12_clean_transactions",
    "c24_clean_customers", "c25_counters", "g01_customers_v", "g02_transactions_v", "g03_daily_summary",
    "g05_country_revenue", "j01_join_salted", "j08_not_exists", "j12_fact", "k06_replace_twice", "p01_run",
    "q08_suite", "q10_strict_suite", "q12_duplicate_pairs", "q20_latest_run_summary", "r01_kpis",
    "r05_price_median", "r07_quantity_histograms", "r09_weekday_hours", "r13_describe", "r20_verdict",
    "s01_csv_scan", "s04_holidays", "v08_tx_suite", "v11_short_suite",
)
KEYS = sorted(set(entry.queries()) & set(entry.oracle_sql())) if os.environ.get("ORACLE_ALL") else SELECTION

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    """Those of the engine itself; what SQL cannot express is tested in ``tests/llm``."""
    assert set(registered()) == set(oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, con, key):
    assert differences(entry.queries()[key](spark, SF), con, entry.oracle_sql()[key]) == []
