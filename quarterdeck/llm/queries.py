"""The registered queries of this subpackage, each an operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm import (
    alignment,
    conversations,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    passages,
    quality,
    surrogates,
    token_counts,
    toxicity,
    vectors,
)
from quarterdeck.llm.fingerprint import fingerprints


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents")).drop("edited")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents")).drop("kept")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("spark.quarterdeck.surrogate.key", "quarterdeck")
    return surrogates.surrogate_report(_table(spark, sf_dir, "documents"), key)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_report(_table(spark, sf_dir, "documents"))


def op8_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.neighbours(_table(spark, sf_dir, "embeddings"), every=100, k=10)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), with_ids=False)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(_table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeats_report(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_order_minhash": op1_order_minhash,
    "op2_mix_sources": op2_mix_sources,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality": op4_quality,
    "op5_surrogates": op5_surrogates,
    "op6_toxicity": op6_toxicity,
    "op7_near_dedup": op7_near_dedup,
    "op8_hnsw": op8_hnsw,
    "op9_packing": op9_packing,
    "op10_token_counts": op10_token_counts,
    "op11_alignment": op11_alignment,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {
    "op2_mix_sources": mixing.ORACLE,
    "op3_line_dedup": line_dedup.ORACLE,
    "op12_suffix_dedup": passages.ORACLE,
    "op13_conversation_repair": conversations.ORACLE,
}
