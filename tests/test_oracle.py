"""Every registered query against its DuckDB twin on the sf0.001 tables (the driver does the same
at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from ranklight.plans.catalog import QUERIES
from tools.check_oracle import TABLES, canon

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))  # the training-data queries have tests of their own
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(df.columns) > 0
        return
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    assert canon(df.columns, rows) == canon(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
