"""Every registered query with an oracle matches DuckDB on sf0.001; the others run."""

import re

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from tools.compare_oracle import TABLES, digest

# The training-data operators have tests of their own.
QUERIES = {k: v for k, v in E.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, data = df.columns, [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(data) > 0 and len(set(cols)) == len(cols)
        return
    res = con.execute(SQL[name])
    ocols = [d[0] for d in res.description]
    odata = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(data) == len(odata)
    assert digest(cols, data) == digest(ocols, odata)
