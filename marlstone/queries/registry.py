"""Where the query modules put their queries and SQL texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder) under ``name``, with SQL that gives the same rows."""

    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return keep
