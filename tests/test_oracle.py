"""Every query with oracle SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, duck


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_oracle(spark, con, small, name):
    assert compare(spark, con, small, name) == ""


def test_registry(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).columns[:2] == ["match_id", "result"]
