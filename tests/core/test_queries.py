"""Every query with SQL against DuckDB over the smallest tables."""

from __future__ import annotations

import math
import os

import pytest

from orolog.plans import catalog

SF = os.environ.get("OROLOG_TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents pages conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def bag(names: list[str], columns: list[str], rows) -> list[tuple]:
    order = [columns.index(n) for n in names]
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_equals_its_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    want = duck.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    names = sorted(columns)
    rows = got.collect()
    assert rows and bag(names, got.columns, rows) == bag(names, columns, want.fetchall())


def test_entry_lists_the_core_queries():
    import __spark_entry__ as e

    assert catalog.queries().keys() <= e.queries().keys() and catalog.oracle_sql().keys() <= e.oracle_sql().keys()


def test_pair_rows_use_one_exchange(spark):
    plan = catalog.event_pairs_rows(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
