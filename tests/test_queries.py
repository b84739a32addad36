"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import MORE, entry, oracle_sql, queries
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_all_queries_have_sql():
    assert set(QUERIES) - set(MORE) <= set(SQL)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_sql_is_text():
    assert all(isinstance(sql, str) for sql in SQL.values())
