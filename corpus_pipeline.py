"""The corpus pipeline: stages that each take (spark, docs, sf_dir) and return a DataFrame.

Every stage works on all documents that the one before it kept; run() writes each result as Parquet and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curatrix.llm import language_id, near_copies, packing, quality, suffix_dedup
from curatrix.llm.common import stored, table
from curatrix.sources.session import ship_code


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or are far from their language's histograms."""
    return quality.quality_filter(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told."""
    ship_code(spark)
    return language_id.language_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles at similarity 0.8 and more."""
    ship_code(spark)
    return near_copies.near_copy_filter(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 100 bytes and more that start earlier in the corpus; n_chars follows."""
    ship_code(spark)
    return suffix_dedup.suffix_dedup_filter(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the remaining texts into sequences: a row for each piece."""
    ship_code(spark)
    return packing.packed_digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language),
    ("near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("best-fit packing", packed_sequences),
]
#: SQL can express neither the fused language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
