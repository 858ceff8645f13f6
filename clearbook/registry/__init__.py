"""Named queries over the sample tables and, for each, SQL text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query function under its own name, with its SQL twin where there is one."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            SQL[key] = sql
        return function

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """All registered queries and their SQL."""
    from clearbook.registry import (  # noqa: F401
        aggregates,
        calendar,
        conforming,
        filtering,
        ingesting,
        joining,
        settlement,
        storage,
        jobs,  # isort: skip  uses the SQL of others
        archiving,  # isort: skip
        updating,  # isort: skip
        reporting,  # isort: skip
    )

    return dict(QUERIES), dict(SQL)
