"""Corpus pipeline: quality classifier, near duplicates, benchmark
decontamination, secret scans, packing. Each stage works on all that the one
before kept and is written as Parquet; all but the last return documents.

``ORACLE_SQL`` is None: a trained model decides in the first and the fourth
stage, which SQL can't express; the tests hold every stage against a
brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandops.llm import decontamination, jaccard_join, packing, quality_lm, secret_scan
from demandops.llm.common import cut, shield, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model accepts."""
    plain, restore = shield(docs, ["doc_id", "text", "lang"])
    return restore(quality_lm.classify(plain, table(spark, sf_dir, "labels")).filter("accepted"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, confirmed secrets replaced; n_chars follows the text."""
    clean = secret_scan.redact(docs, secret_scan.scan(docs))
    if "n_chars" in docs.columns:
        return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark", benchmark),
          ("secrets", secret_stage), ("packing", best_fit)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
