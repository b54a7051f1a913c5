"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from quotaloom.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (4, str(v))
    if isinstance(v, (int, float)):
        return (2, "nan" if isinstance(v, float) and math.isnan(v) else repr(float(v)))
    return (5, str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[key])
    d_cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, s_rows) == _rows(d_cols, cur.fetchall())


@pytest.mark.parametrize("key", sorted(set(queries()) - set(oracle_sql())))
def test_rows_only_queries_run(spark, key):
    assert queries()[key](spark, SF).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["rep_name", "region", "territory", "month_year", "total_closed", "won", "win_rate"]
    assert df.count() > 0
