"""The queries over the corpus operators, one for each, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from orolog.llm import decontaminate, langid, mixing, pii, quality, secret_scan, sharding, simhash, sql, tokens, toxicity
from orolog.llm._shared import documents, held_out

SHARDS = 16
#: Vocabulary file of op9.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    docs = documents(spark, sf_dir)
    samples = secret_scan.random_strings(spark).unionByName(secret_scan.ordinary_identifiers(docs))
    return secret_scan.digest(secret_scan.find_secrets(docs, secret_scan.train(samples)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels that are not held out."""
    docs = documents(spark, sf_dir)
    out = toxicity.score_toxicity(docs, toxicity.train(docs, documents(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(out["doc_id"]).alias("held_out"), "score", (F.col("score") >= toxicity.TOXIC_FROM).cast("int").alias("predicted"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of nearly equal bytes."""
    out = sharding.contiguous_shards(documents(spark, sf_dir), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    out = simhash.near_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    out = pii.find_pii(documents(spark, sf_dir))
    return out.select("doc_id", *(f"n_{k}" for k in pii.KINDS), "n_added", F.sha2("base", 256).alias("base_sha256"), "spans")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in all documents."""
    out = decontaminate.find_overlap(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of all documents by source weights 5, 2, 1, repeating."""
    out = mixing.mix(documents(spark, sf_dir))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and compression bands of all documents, the bands fitted to labelled documents that are not held out."""
    docs = documents(spark, sf_dir)
    return quality.score_quality(docs, fitted_band=quality.fit(docs, documents(spark, sf_dir, "labels"))).drop("n_chunks", "n_bad_chunks")


def op9_tokens(spark: SparkSession, sf_dir: str, pieces: str = PIECES) -> DataFrame:
    """Tokens of all documents under the unigram reading of a vocabulary file."""
    return tokens.count_tokens(documents(spark, sf_dir), tokens.load(pieces))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those that are not held out."""
    docs = documents(spark, sf_dir)
    out = langid.identify(docs, langid.train(docs.where(~held_out(docs["doc_id"])).select("doc_id", "lang", "text")))
    return out.select("doc_id", held_out(out["doc_id"]).alias("held_out"), "lang_pred", "score", "n_spans")


def base_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op1_secrets that SQL can express."""
    return op1_secrets(spark, sf_dir).select("doc_id", *(f"n_{k}" for k in secret_scan.KINDS), "base_sha256")


def base_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op5_pii that SQL can express."""
    return op5_pii(spark, sf_dir).select("doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256")


def base_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op8_quality that SQL can express."""
    return op8_quality(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op7_mixing that SQL can express."""
    return op7_mixing(spark, sf_dir).select("doc_id", "size", "source_size", "target")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secrets": op1_secrets,
        "op2_toxicity": op2_toxicity,
        "op3_sharding": op3_sharding,
        "op4_simhash": op4_simhash,
        "op5_pii": op5_pii,
        "op6_decontamination": op6_decontamination,
        "op7_mixing": op7_mixing,
        "op8_quality": op8_quality,
        "op9_tokens": op9_tokens,
        "op10_language": op10_language,
        "pipeline": corpus_pipeline.run,
        "base_secrets": base_secrets,
        "base_pii": base_pii,
        "base_quality": base_quality,
        "mix_targets": mix_targets,
    }


def oracle_sql() -> dict[str, str]:
    base = {"base_secrets": sql.SECRETS, "base_pii": sql.PERSONAL, "base_quality": sql.QUALITY, "mix_targets": sql.TARGETS}
    return {"op3_sharding": sql.SHARDING, "op6_decontamination": sql.DECONTAMINATION} | base | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
