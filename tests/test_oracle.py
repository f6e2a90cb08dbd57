"""Every query against its SQL on the whole sf0.01 tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in sorted(os.listdir(FOLDER)):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{FOLDER}/{name}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.12g}"
    return "null" if v is None else str(v)


def table(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    rows = df.collect()
    sql = oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cur = duck.execute(sql)
    want_cols, want = table(cur.fetchall(), [d[0] for d in cur.description])
    got_cols, got = table([tuple(r) for r in rows], df.columns)
    assert got_cols == want_cols
    assert len(got) == len(want)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    assert not bad, f"{len(bad)} of {len(got)} rows differ, first: {bad[:3]}"
