"""Every registered query that has SQL gives what the SQL gives on the same tables."""

import pytest

from ebbtide.queries import registry
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.01"
QUERIES, SQL = registry()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 36
    assert set(entry.oracle_sql()) <= set(entry.queries())
