"""Shards against the law they promise."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from orolog.llm import sharding
from orolog.llm._shared import partitions


def rows(n: int) -> list[tuple]:
    return [(i % 40 if i % 7 else None, None if i % 11 == 0 else ("é" * (i % 5) + "x" * (i * i % 300) if i % 3 else "hot"), i) for i in range(n)]


@pytest.mark.parametrize(("n", "shards"), [(500, 16), (500, 1), (7, 16), (1, 3)])
def test_contiguous_balanced_gapless(spark, n, shards):
    data = rows(n)
    df = spark.createDataFrame(data, "doc_id long, text string, shard int").repartition(5)
    got = sharding.contiguous_shards(df, shards).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted((-1 if i is None else i, size(t), zlib.crc32((t or "").encode())) for i, t, _ in data)
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["size"])
    placed = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [key(r) for r in placed] == sorted(key(r) for r in got)  # one order through all shards
    total, most = sum(r["size"] for r in got), max(r["size"] for r in got)
    for s in range(shards):
        mine = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        assert abs(sum(r["size"] for r in mine) - total / shards) <= most


def test_carried_columns_and_empty_table(spark):
    df = spark.createDataFrame(rows(30), "doc_id long, text string, shard int")
    got = sharding.contiguous_shards(df, 4, carry=df.columns).select("row.*").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, df.collect()))
    assert sharding.contiguous_shards(df.limit(0), 4).count() == 0
    with pytest.raises(ValueError, match="positive"):
        sharding.contiguous_shards(df, 0)


def test_equal_rows_are_spread_over_tasks(spark, tmp_path):
    n = 100_000
    docs = spark.range(n, numPartitions=8).selectExpr("cast(null as string) doc_id", "'hot' text").unionByName(spark.range(20_000).selectExpr("cast(id as string) doc_id", "repeat('x', int(id % 50)) text"))
    docs.write.parquet(str(tmp_path / "documents"))
    got = sharding.contiguous_shards(spark.read.parquet(str(tmp_path / "documents")), 16)
    rows = got.groupBy("shard").agg({"size": "sum", "slot": "max", "doc_id": "count"}).collect()
    assert got.count() == n + 20_000 and len(rows) == 16
    sizes = [r["sum(size)"] for r in rows]
    assert max(sizes) - min(sizes) <= 2 * 51
    read = [r["count"] for r in got.groupBy(F.input_file_name().alias("p")).count().collect()]
    assert max(read) < 1.5 * (n + 20_000) / partitions(spark)  # the exchange dealt the equal rows out


def test_one_very_long_text(spark):
    df = spark.createDataFrame([("b", "x" * 3_000_000), ("a", "y"), ("c", None), ("c", None)], "doc_id string, text string")
    got = sorted((r["doc_id"], r["size"], r["shard"], r["slot"]) for r in sharding.contiguous_shards(df, 4).collect())
    assert got == [("a", 2, 0, 0), ("b", 3_000_001, 2, 0), ("c", 1, 3, 0), ("c", 1, 3, 1)]
