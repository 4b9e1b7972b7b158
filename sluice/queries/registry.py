"""Query registry: a Spark callable per key, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.queries.views import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    """Register a query; ``views`` names the derived tables its SQL builds on."""

    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_views(sql, views)
        return fn

    return register


def with_views(sql: str, views: str) -> str:
    wanted: list[str] = []

    def add(name: str) -> None:
        needs, _ = VIEWS[name]
        for need in needs.split():
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in views.split():
        add(name)
    body = sql.strip()
    parts = [f"{name} AS ({VIEWS[name][1].strip()})" for name in wanted]
    if body[:5].upper() == "WITH ":
        return "WITH " + ", ".join([*parts, body[5:]]) if parts else body
    return "WITH " + ", ".join(parts) + " " + body if parts else body
