"""Importing this module registers every query."""

from sluice.queries import analyses, basics, deliveries, records, relational, series, storage, streams  # noqa: F401
from sluice.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
