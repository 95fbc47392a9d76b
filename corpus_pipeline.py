"""The corpus pipeline: quality rules, near-duplicates, benchmark decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return documents.

Edge cases: null and empty texts fail the quality rules; later stages keep them if they get any, and packing makes
them the end token alone. Of rows that repeat a doc_id, or have none and equal sets, near_duplicates keeps one.
Nulls in other columns count as values; further columns pass through all stages but packing; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.decontaminate import clean_documents
from tidemark.llm.minhash import deduplicated
from tidemark.llm.packing import packed
from tidemark.llm.personal import redacted
from tidemark.llm.quality import kept_documents

#: No SQL: near-duplicates and token ids can't be expressed in it. Tested against plain versions.
ORACLE_SQL = None


#: Documents whose sets of word shingles are so alike (Jaccard, in per cent) are near duplicates.
NEAR_PERCENT = 80
#: Words whose token ids a worker remembers; it lives on through other stages and keeps them.
REMEMBERED = 100_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, at NEAR_PERCENT."""
    return deduplicated(docs, NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in training sequences."""
    return packed(docs, memory=REMEMBERED)


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, on the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
