"""Queries by operator ID, each with its DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function of (spark, sf_dir) under an operator's ID."""

    def add(f: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = f
        if sql:
            SQL[key] = sql
        return f

    return add
