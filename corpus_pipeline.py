"""A corpus from documents: language, lines, near-duplicates, repeated passages, packing.

Each stage reads what the one before has kept, written as Parquet in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import ppm_language, simhash_trie, site_lines, stock_packing, suffix_dedup
from tillwise.staging import stage


#: Documents that go to Python and back at a time. Spark's own default of 10,000 would hold
#: tens of megabytes of text in each of several buffers.
BATCH_ROWS = "1000"


def in_small_batches(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, with the session's Arrow batches made small, also for what is still to run."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return function(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return ppm_language.identified(docs, ppm_language.fit(docs))


@in_small_batches
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that too many documents of their source have."""
    return site_lines.clean_documents(docs)


@in_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash_trie.keep_one(docs)


@in_small_batches
def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere too."""
    return suffix_dedup.without_repeats(docs)


@in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return stock_packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("packing", packing),
]

#: The statistics of languages, fingerprints and tokens have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), "corpus-" + name.split()[0].lower())
    return docs
