"""Every query against its SQL on the smallest tables; `python tests/oracle.py <folder>` runs larger ones."""

import os

import pytest
from oracle import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from surveylake.bindings.oracle import ORACLE_SQL
from surveylake.bindings.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.items() <= queries().items() and ORACLE_SQL.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SF_DIR), connection, ORACLE_SQL[name]) is None


def test_entry(spark):
    assert entry(spark).count() == 3
