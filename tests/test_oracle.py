"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_of(df.columns, s_rows) == rows_of(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "orders_per_10k" in df.columns
