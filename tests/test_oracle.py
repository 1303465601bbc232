"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

import pytest

import __spark_entry__ as E
from tests.oracle import compare, duck_connect

_Q = E.queries()
_SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_connect(sf_dir)


@pytest.mark.parametrize("name", sorted(_Q))
def test_query_matches_oracle(spark, con, sf_dir, name):
    r = compare(spark, con, name, _Q[name], _SQL.get(name), sf_dir)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert len(df.columns) > 0
