"""Queries that SQL can express, against that SQL."""

from __future__ import annotations

import pytest
from oracle import connect, differences

import __spark_entry__ as entry
from veritill.llm import queries


@pytest.mark.parametrize("key", sorted(queries.oracles()))
def test_query(spark, sf, key):
    assert differences(entry.queries()[key](spark, sf), connect(sf), queries.oracles()[key]) == []


def test_one_query_for_each_operator():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in names if name.startswith("op") and name[2].isdigit()}
    assert "pipeline" in names
