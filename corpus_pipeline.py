"""The corpus pipeline: quality rules, near-duplicate removal, benchmark decontamination,
secret removal and BPE encoding, each stage on all that the one before it kept.

Each stage takes (spark, docs, sf_dir); ``run`` writes its result as Parquet in the shared
folder and reads it again as the next one's docs. No stage looks at other columns than
doc_id and text, but every one carries all columns of ``documents``; the last adds n_tokens
and ids. Empty tables pass through every stage; a null text has no words and is rejected
by the first one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import bpe_automaton, decontaminate, minhash_dedup, quality_rules, secret_scan
from kiln.llm.common import table, written
from kiln.llm.queries import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates."""
    return minhash_dedup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked, and n_chars that of the new text."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with n_tokens and ids (little-endian unsigned 32-bit integers)."""
    return bpe_automaton.with_ids(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("minhash_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("bpe_encoding", encoding_stage),
]

#: Quality probabilities, sketches and BPE have no form in SQL; the tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
