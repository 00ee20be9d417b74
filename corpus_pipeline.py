"""The corpus pipeline: quality rules, near duplicates, repeated passages, mixing, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.ngram_join import one_per_group
from tidemark.llm.packing import packed
from tidemark.llm.quality import accepted
from tidemark.llm.substrings import without_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle similarity 0.8 or more."""
    return one_per_group(docs, 5, 80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one holds; ``n_chars`` follows the text."""
    columns = docs.columns
    cleaned = without_repeats(docs)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(kind)
        cleaned = cleaned.withColumn("n_chars", length)
    return cleaned.select(*columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents as training sequences."""
    return packed(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL has no similarity groups, gear hash or tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
