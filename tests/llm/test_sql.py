"""Operator queries against the same queries in SQL."""

from __future__ import annotations

import pytest
from compare import connect, difference

from editpulse.llm.oracles import oracle_sql
from editpulse.llm.queries import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, name):
    assert difference(queries()[name](spark, SF_DIR), connect(SF_DIR), oracle_sql()[name]) is None
