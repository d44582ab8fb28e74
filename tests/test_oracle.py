"""Every SQL-expressible query equals its DuckDB text (rows, columns, values)."""

import pytest

import __spark_entry__ as E
from tests.helpers import canon, duck

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duck(sf_dir)
    yield c
    c.close()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, sf_dir, con, name):
    df = E.queries()[name](spark, sf_dir)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    cur = con.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert canon(rows, cols) == canon(drows, dcols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["account_id", "avg_balance_obs", "avg_balance_label", "balance_ratio", "churned"]

