"""Registry of queries and of the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    _CTES[name] = sql.strip()


def with_ctes(body: str) -> str:
    """Prefix `body` with the shared CTEs it needs, found by name, dependencies first."""
    needed: list[str] = []
    seen: set[str] = set()

    def visit(sql: str) -> None:
        for name, text in _CTES.items():
            if name not in seen and re.search(rf"\b{name}\b", sql):
                seen.add(name)
                visit(text)
                needed.append(name)

    visit(body)
    parts = [f"{n} AS (\n{_CTES[n]}\n)" for n in needed]
    own = re.match(r"\s*WITH\s+(.*)", body, re.S)
    if own:
        return "WITH RECURSIVE " + ",\n".join([*parts, own[1]])
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `sql` is its DuckDB twin (omitted when SQL cannot express it)."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return fn

    return register
