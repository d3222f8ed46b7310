"""The corpus pipeline: language, near-duplicates, benchmark passages, source mix, shards.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. All but the last
return the columns of `documents`. `run` writes each stage's rows to the shared folder and reads them back for
the next, as the driver of a cluster would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orolog.llm import decontaminate, langid, mixing, near_copies, sharding
from orolog.llm._shared import cut, documents, held_out, release, written

#: A document goes if no language is found or the one found scores less.
LEAST_LANGUAGE = 0.35
SHARDS = 16

#: No stage's decisions but the last's are rows that SQL can compute; the tests hold them against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without a letter, or without a language that scores LEAST_LANGUAGE, go."""
    model = langid.train(docs.where(~held_out(docs["doc_id"])).select("doc_id", "lang", "text"))
    return langid.keep_identified(docs, model, LEAST_LANGUAGE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word shingles, similarity 0.8 or more): that of the smallest id."""
    return near_copies.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window; a document in which one occurs goes."""
    return decontaminate.drop_overlap(docs, documents(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes; one that it takes no times goes."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in contiguous shards of nearly equal bytes, with their places; columns of those names give way to them."""
    places = ("shard_bytes", "shard", "slot")
    out = sharding.contiguous_shards(docs, SHARDS, carry=[c for c in docs.columns if c.lower() not in places])
    return out.select("row.*", F.col("size").alias("shard_bytes"), "shard", "slot")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mix", mix),
    ("shards", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs, before = documents(spark, sf_dir), written()
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
        release(spark, before)  # the tables that led to it
    return STAGES[-1][1](spark, docs, sf_dir)
