"""Every registered query against its SQL on DuckDB, over whole tables."""

from __future__ import annotations

import pytest
from conftest import MEDIUM, SMALL
from oracle_check import compare, connect

from sluice.queries.catalog import ORACLES, QUERIES


# The smallest data has too few rows in an hour for these to find anything.
NEEDS_MORE = {"alerts", "anomaly_1h", "anomaly_type", "stream_alerts"}


@pytest.fixture(scope="module")
def duck():
    return {folder: connect(folder) for folder in (SMALL, MEDIUM)}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, duck, key):
    folder = MEDIUM if key in NEEDS_MORE else SMALL
    assert compare(spark, duck[folder], folder, QUERIES[key], ORACLES[key]) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, key):
    assert QUERIES[key](spark, SMALL).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
