"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in _queries:
            raise ValueError(f"query {name} registered twice")
        _queries[name] = fn
        if sql is not None:
            _sql[name] = sql
        return fn

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
