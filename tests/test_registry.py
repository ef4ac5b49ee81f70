"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import ROOT
from tools.compare import duck, rows_of_duck, rows_of_spark

# The queries of corpus operators are tested in tests/llm.
QUERIES, SQL = entry.QUERIES, entry.SQL


@pytest.fixture(scope="module")
def con():
    return duck(ROOT)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    cols, got = rows_of_spark(QUERIES[name](spark, ROOT))
    if name in SQL:
        names, want, _ = rows_of_duck(con, SQL[name])
        assert cols == names
        assert got == want
