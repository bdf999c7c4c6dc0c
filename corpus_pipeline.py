"""The training-data pipeline over ``documents``: stages that each keep, drop or pack what the one before kept."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cytospark.llm import language_id, packing, quality_rules, simhash
from cytospark.llm.common import table
from cytospark.session import scratch_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the base rules or their host's verdict reject."""
    return quality_rules.keep_good(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language cannot be told."""
    return language_id.keep_identified(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group."""
    return simhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences; one row per piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("language ID", language_stage),
    ("SimHash near-dedup", dedup_stage),
    ("best-fit packing", packing_stage),
]

# Compression, XXH64 fingerprints and the tokenizer have no counterpart in SQL; the stages are tested
# against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_folder(spark)
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
