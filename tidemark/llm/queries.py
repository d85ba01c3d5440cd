"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from tidemark.llm import (
    chat_format,
    collocations,
    decontamination,
    exact_dedup,
    html_text,
    language_id,
    near_dedup,
    pii,
    quality,
    sentencepieces,
    token_counts,
    toxicity,
    whitening,
)
from tidemark.llm.common import read_table


def op1_chat_format(spark, sf_dir):
    return chat_format.formatting_report(read_table(spark, sf_dir, "conversations"))


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op3_token_counts(spark, sf_dir):
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"))


def op4_decontamination(spark, sf_dir):
    found = decontamination.contamination_report(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return found.drop("longest_match", "spans")  # the digest columns, which SQL has too


def op5_language_id(spark, sf_dir):
    return language_id.language_report(read_table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark, sf_dir):
    return sentencepieces.encoding_report(read_table(spark, sf_dir, "documents"))


def op7_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), words=3, similarity=0.85)


def op8_pii(spark, sf_dir):
    return pii.find_spans(read_table(spark, sf_dir, "documents"))


def op9_html_text(spark, sf_dir):
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


def op10_toxicity(spark, sf_dir):
    return toxicity.toxicity_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_quality(spark, sf_dir):
    return quality.quality_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_collocations(spark, sf_dir):
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op13_whitening(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_decontamination": op4_decontamination,
    "op5_language_id": op5_language_id,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_near_dedup": op7_near_dedup,
    "op8_pii": op8_pii,
    "op9_html_text": op9_html_text,
    "op10_toxicity": op10_toxicity,
    "op11_quality": op11_quality,
    "op12_collocations": op12_collocations,
    "op13_whitening": op13_whitening,
}

ORACLES = {
    "op1_chat_format": lambda: chat_format.ORACLE_SQL,
    "op2_exact_dedup": lambda: exact_dedup.ORACLE_SQL,
    "op4_decontamination": lambda: decontamination.ORACLE_SQL,
    "op12_collocations": lambda: collocations.ORACLE_SQL,
}
