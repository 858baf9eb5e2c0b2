"""Sessions made elsewhere get the limit on generated methods that HotSpot needs."""

from __future__ import annotations

import pytest

from veritill import session
from veritill.catalogue.registry import registered


@pytest.fixture()
def limit(spark):
    before = spark.conf.get(session.HUGE_METHODS)
    yield lambda value: spark.conf.set(session.HUGE_METHODS, str(value))
    spark.conf.set(session.HUGE_METHODS, before)


def test_queries_split_methods_that_are_not_compiled(spark, limit):
    limit(session.SPARK_LIMIT)
    with pytest.raises(Exception):  # the tables are not there; the setting comes first
        registered()["c12_clean_transactions"](spark, "/nowhere").collect()
    assert spark.conf.get(session.HUGE_METHODS) == "8000"


def test_a_limit_of_the_session_stays(spark, limit):
    limit(4000)
    session.compile_small(spark)
    assert spark.conf.get(session.HUGE_METHODS) == "4000"
