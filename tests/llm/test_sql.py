"""The SQL counterparts on the small tables."""

from __future__ import annotations

import duckdb
import pytest

from tidecast.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_counterpart(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, FOLDER).select(*columns).collect()
    assert got and sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))
