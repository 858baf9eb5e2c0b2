"""Registry of queries and of the SQL that checks them."""

from __future__ import annotations

import functools
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from veritill.session import compile_small, shuffles_freed

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = ("layers", "raw_checks", "cleaning", "enrichment", "views", "quality", "anomalies", "reports", "upkeep")


def _compiled_small(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        compile_small(spark)
        with shuffles_freed(spark):
            return fn(spark, sf)

    return run


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the statement that checks it."""

    def register(fn: Query) -> Query:
        if key in _QUERIES:
            raise ValueError(f"query {key} is registered twice")
        _QUERIES[key] = _compiled_small(fn)
        if sql is not None:
            _SQL[key] = sql
        return fn

    return register


def _import_all() -> None:
    for module in _MODULES:
        import_module(f"veritill.catalogue.{module}")


def registered() -> dict[str, Query]:
    _import_all()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _import_all()
    return dict(_SQL)
