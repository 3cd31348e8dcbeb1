"""One decorator to register a query, what it covers and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query under ``name``; ``covers`` lists inventory ids it exercises."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name], COVERS[name] = fn, covers
        if sql:
            SQL[name] = sql
        return fn

    return register


def r(value: Column | str, digits: int = 6) -> Column:
    """Rounded double for value comparison; negative zero becomes zero."""
    v = F.col(value) if isinstance(value, str) else value
    return F.round(v.cast("double"), digits) + F.lit(0.0)


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
