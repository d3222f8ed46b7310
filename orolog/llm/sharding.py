"""Sharding: global byte-size prefix sums from per-partition totals, cut at equal targets.

Rows are put into one global order (doc_id, text checksum, size; nulls first) by a range exchange of the
slim columns only. Each task writes its running sums within its own partition; the totals of the partitions,
one row each, turn them into global prefix sums. A row goes to the shard in whose equal slice of all bytes
its middle lies, so that shards are contiguous in the global order and differ by about one document.
No group of rows ever meets in one task: rows equal in all three columns are interchangeable, and a last key, the
place where a row was read, lets the exchange cut between them. It has to be the same when a task runs again, so
``df`` is read from files, as every stage of the pipeline is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orolog.llm._shared import columns, running_sums

LAW = "bytes"


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1 for the separator."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 text; a null text counts as empty (0)."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def contiguous_shards(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Assign every row of ``df`` to one of ``n_shards`` contiguous shards of nearly equal bytes.

    Returns ``doc_id, size, text_crc32, shard, slot`` and, under ``row``, a struct of the ``carry`` columns
    where any are asked for. ``slot`` counts from 0 without gaps in each shard, in global order.
    Null texts have size 1; null ids come first; ties and repeated rows each get a place of their own;
    an empty table gives no rows; a shard that no document's middle falls into stays empty. Other columns
    of ``df`` may have any names: only the named ones are read.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    slim = df.select(
        df[id_col].alias("doc_id"),
        byte_size(df[text_col]).alias("size"),
        text_crc(df[text_col]).alias("text_crc32"),
        *([F.struct(*columns(df, carry)).alias("row")] if carry else []),
    )
    slim = slim.withColumn("tie", F.monotonically_increasing_id())  # of rows that are equal: else all of them would meet in one task
    ordered = running_sums(slim, ["doc_id", "text_crc32", "size", "tie"], {"bytes_before": "size"}, "rank", "shard-sums")
    total = ordered.agg(F.max(F.col("bytes_before") + F.col("size")).alias("bytes")).first()["bytes"] or 1
    shard = F.expr(f"cast(least({n_shards - 1}, ((2 * bytes_before + size) * {n_shards}L) div {2 * total}L) as int)")
    placed = ordered.select(*(c for c in slim.columns if c != "tie"), shard.alias("shard"), "rank")
    firsts = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(F.min("rank").alias("first")).collect()}  # one row for each shard
    starts = F.array(*(F.lit(int(firsts.get(s, 0))) for s in range(n_shards)))
    return placed.withColumn("slot", (F.col("rank") - F.element_at(starts, F.col("shard") + 1)).cast("long")).drop("rank")
