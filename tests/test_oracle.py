"""Every registered query equals its DuckDB oracle on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return "NaN" if isinstance(v, float) and math.isnan(v) else repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark, duck):
    df = entry(spark)
    assert df.count() == duck.execute(f"SELECT count(*) FROM ({oracle_sql()['gold_features']})").fetchone()[0] > 0
    assert df.columns[:4] == ["date", "store", "item", "sales"]


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(rows) >= 1
        return
    res = duck.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _canon(df.columns, rows) == _canon(dcols, drows)
