"""Every registered query with oracle SQL equals DuckDB on sf0.01."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE
from tests.oracle import compare, duck

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_duckdb(spark, con, key):
    got = E.queries()[key](spark, SF_ORACLE).toPandas()
    want = con.execute(SQL[key]).df()
    problems = compare(got, want)
    assert not problems, f"{key}: {problems}"
