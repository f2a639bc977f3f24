"""The corpus pipeline: stages from raw documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestep.llm import stages
from lodestep.llm.common import prepare, read, stored

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("exact_dedup", stages.exact_dedup),
    ("near_dedup", stages.near_dedup),
    ("secret_scan", stages.redact_secrets),
    ("packing", stages.packed),
]

#: SQL has no tokenizer, so none for the packed result; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again as the next one's documents."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
