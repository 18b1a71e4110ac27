"""Every registered query against its DuckDB counterpart."""

import pytest
from conftest import FOLDER

import __spark_entry__
from checks import registry
from checks.compare import differences

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 99


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert not __spark_entry__.entry(spark).isEmpty()
