"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from opslog.catalog import load

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    return repr(v) if isinstance(v, float) else str(v)


def table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(load()))
def test_query_equals_sql(name, spark, data, duck):
    df = entry.queries()[name](spark, data)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == table(names, cur.fetchall())


def test_every_query_has_sql():
    assert set(load()) <= set(entry.queries())
    assert all(e.sql for e in load().values())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "stat_key"
    assert df.limit(1).count() == 1
