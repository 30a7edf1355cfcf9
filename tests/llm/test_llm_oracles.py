"""Contract queries against their SQL."""

import duckdb
import pytest

from quarry.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = db.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    out = queries.queries()[name](spark, SF)
    assert sorted(out.columns) == sorted(columns)
    assert sorted(map(tuple, out.select(columns).collect())) == sorted(want.fetchall())
