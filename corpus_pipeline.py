"""The corpus pipeline: toxicity, line dedup, near copies, decontamination, encoding.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import bpe, decontam, jaccard, linededup, toxicity
from topicloom.llm.common import land, table
from topicloom.session import ship_package

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    ship_package(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go from the texts; a document all of whose
    lines were later copies goes with them.  n_chars follows the text."""
    out = linededup.dedup_lines(docs)
    out = out.where("n_deleted = 0 or n_deleted < n_lines")
    if "n_chars" in docs.columns:
        n = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_deleted") > 0, n).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship_package(spark)
    return jaccard.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark windows go from the texts; documents made of them go."""
    ship_package(spark)
    out = decontam.remove_leaks(docs, table(spark, sf_dir, "benchmark"))
    if "n_chars" in docs.columns:
        n = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(n))
    return out.select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with digests of ids and of decoded bytes."""
    ship_package(spark)
    return bpe.encode_documents(docs, VOCABULARY, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", toxic_documents),
    ("line_dedup", repeated_lines),
    ("ngram_jaccard", near_copies),
    ("decontamination", benchmark_leaks),
    ("bpe", encoded),
]

#: SQL can't express the fitted classifier nor the merges; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
