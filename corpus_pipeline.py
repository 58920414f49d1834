"""A corpus from raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read back as the next
one's ``docs``. All but the last return the columns of documents.

1. toxicity: rejected documents go.
2. line dedup: lines that three documents or more repeat stay in the one with the largest id only.
3. near dedup: of every group of near copies (five words, 0.8) the document with the smallest id stays.
4. mixing: sources are brought to their target weights; a document is repeated up to three times.
5. packing: documents become pieces of sequences of 1024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm.line_dedup import without_repeated_lines
from quarterdeck.llm.mixing import mix
from quarterdeck.llm.near_dedup import without_near_copies
from quarterdeck.llm.packing import pack_documents
from quarterdeck.llm.toxicity import fit, without_toxic
from quarterdeck.workspace import written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without_toxic(docs, fit(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Trees, signatures and token ids are not for SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; every result but the last is written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
