"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from sluice.queries.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
