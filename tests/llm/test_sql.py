"""Queries over the corpus against their SQL, value by value."""

from __future__ import annotations

import os

import pytest

from orolog.llm import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_gives_what_its_sql_gives(spark, name):
    import duckdb

    base = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = base.execute(Q.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = Q.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))
