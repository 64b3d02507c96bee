"""Every registered query against its DuckDB SQL on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from docflow.plans import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    result = duck.execute(SQL[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == columns
    want = sorted(repr([plain(dict(zip(names, r, strict=True))[c]) for c in columns]) for r in result.fetchall())
    assert got == want
