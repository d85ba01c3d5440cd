"""Corpus pipeline: language ID, exact dedup, near-duplicate removal, decontamination, SentencePiece encoding.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``; a lost executor or a failed stage therefore never goes
back further than the last written stage. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, exact_dedup, language_id, near_dedup, sentencepieces
from tidemark.llm.common import fold_col, read_table
from tidemark.session import ship_package, tables_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null text, no letter) go; learned from the labelled documents that are not held out."""
    ship_package(spark)
    return language_id.keep_identified(docs, language_id.learn(docs, fold_col("doc_id", 4) != 2))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    ship_package(spark)
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 the one with the smallest doc_id stays."""
    ship_package(spark)
    return near_dedup.drop_near_copies(docs, words=5, similarity=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go if a twentieth of their words lies in 13-word windows of a benchmark item."""
    ship_package(spark)
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that stay, with their token ids and whether decoding the ids gives the text back."""
    ship_package(spark)
    return sentencepieces.encode(docs, check_col="restored")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", decontaminate),
    ("sentencepiece", encode_pieces),
]

#: the near-duplicate and language stages are not expressible in SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    base = f"{tables_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
