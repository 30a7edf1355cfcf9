"""Every registered core query against its SQL in DuckDB."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

from quarry.plans import queries as core

SF = os.environ.get("QUARRY_TEST_DATA", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() if isinstance(v, dt.date) else v


def rows(names, data):
    by = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in by) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    out = core.queries()[name](spark, SF)
    want = duck.sql(core.oracle_sql()[name])
    assert sorted(out.columns) == sorted(want.columns)
    assert rows(out.columns, [tuple(r) for r in out.collect()]) == rows(want.columns, want.fetchall())
    assert out.count() > 0


def test_every_query_is_registered(spark):
    assert set(core.oracle_sql()) <= set(core.queries())
