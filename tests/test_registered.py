"""Every registered query with a SQL form gives the same rows, names and types on DuckDB."""

import pytest

from tests.compare import connect, difference
from xoutcome.catalog import registered

SF = "/root/testdata/sf0.001"
QUERIES = registered()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_same_as_sql(spark, con, name):
    found = QUERIES[name].run(spark, SF).toArrow()
    assert difference(found, con.sql(QUERIES[name].sql).to_arrow_table()) is None


def test_entry_returns_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
