"""Corpus pipeline: quality, language, near-duplicates, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hivewire.llm import bpe, decontaminate, langid, minhash, quality
from hivewire.llm.common import prepare, written
from hivewire.sources.tables import read_table

NEAR_PERCENT = 80       # op10_minhash alone links from 85 on


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language by a sufficient margin go."""
    return langid.accepted(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (Jaccard similarity from 0.8 on) stays."""
    return minhash.deduplicated(docs, percent=NEAR_PERCENT)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with digests of the ids and of the decoded bytes."""
    return bpe.digests(docs, keep_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

# Compression, discriminants, SimHash and BPE are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
