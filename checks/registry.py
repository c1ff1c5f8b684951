"""The registry: one entry per operator, a Spark query and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def add(function):
        if key in QUERIES:
            raise KeyError(f"registered twice: {key}")
        QUERIES[key] = function
        if sql is not None:
            SQL[key] = sql
        return function
    return add
