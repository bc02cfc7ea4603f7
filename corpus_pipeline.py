"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet to the cluster's shared
folder and read again as the next stage's docs, so a lost executor costs at most the stage that runs. All stages but
the last return the columns of ``documents``; each works on every row that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aeris.llm import exact_dedup, language_id, packing, simhash, suffix_dedup
from aeris.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those of which no language has half of the probability. The model is fitted on the stage's own
    labelled rows."""
    return language_id.accepted(docs, language_id.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space the longest, then smallest doc_id, stays."""
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints are linked at 2 or fewer bits the smallest doc_id stays."""
    return simhash.without_near_copies(docs, shingle=3, max_bits=2, seed=42)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every string of 200 bytes that occurs more than once; documents stay, with what remains of their text."""
    return suffix_dedup.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("suffix_array_dedup", repeated_passages),
    ("best_fit_packing", packed),
]

#: Neither SimHash components nor the packing can be stated in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
