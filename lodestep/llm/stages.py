"""The operators as stages of the pipeline: documents in, documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestep.llm import exact, packing, rules, secret_scan, simhash
from lodestep.llm.common import prepare, read
from lodestep.llm.queries import bpe_file, new_index


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned list keep; the list learns from the labels of these documents.

    Rows that share a doc_id stay only if each of them is kept.
    """
    prepare(spark)
    verdicts = rules.judge(docs, read(spark, sf_dir, "labels"))
    return exact.keep_rows(docs, verdicts.groupBy("doc_id").agg(F.min("kept").alias("kept")).filter("kept"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest doc_id."""
    prepare(spark)
    return exact.deduplicate(docs, new_index(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one with the least doc_id."""
    prepare(spark)
    return simhash.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask in place of every secret; n_chars follows the text where the mask changed it."""
    prepare(spark)
    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their ids."""
    prepare(spark)
    return packing.pack(docs, bpe_file())
