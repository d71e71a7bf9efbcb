"""Every registered query against the same query in SQL."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as entry_points
from editpulse.plans import oracles, registered

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registered.queries()
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, SQL[name]) is None


def test_entry_runs(spark):
    assert entry_points.entry(spark).columns[:3] == ["minute_bucket", "wiki_id", "wiki_db"]
