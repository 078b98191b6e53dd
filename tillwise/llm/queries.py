"""The registered queries of the text operators, one for each, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import (
    bpe_reuse,
    chat_views,
    filter_audit,
    fm_quality,
    gear_fingerprint,
    mcd_rules,
    nra_search,
    phrase_index,
    ppm_language,
    simhash_trie,
    site_lines,
    stock_packing,
    suffix_dedup,
)
from tillwise.llm.common import documents


def op1_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    machine = fm_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return fm_quality.score(docs, machine)


def op2_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_reuse.encode_documents(documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(documents(spark, sf_dir)).drop("spans")


def op4_chat_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_views.views(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op5_gear_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gear_fingerprint.fingerprints(documents(spark, sf_dir))


def op6_mcd_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mcd_rules.judge(documents(spark, sf_dir))


def op7_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_duplicates(documents(spark, sf_dir))


def op8_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock_packing.pack(documents(spark, sf_dir))


def op9_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.clean_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return ppm_language.predict(docs, ppm_language.fit(docs)).drop("bits_per_byte")


def op11_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra_search.rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_fm_quality, op2_bpe_chunk_reuse, op3_suffix_dedup, op4_chat_views, op5_gear_fingerprint,
        op6_mcd_rules, op7_simhash_trie, op8_stock_packing, op9_site_lines, op10_ppm_language,
        op11_nra_search, op12_phrase_index, op13_filter_audit,
    )
}

ORACLES = {
    "op4_chat_views": chat_views.ORACLE, "op9_site_lines": site_lines.ORACLE, "op11_nra_search": nra_search.ORACLE,
    "op12_phrase_index": phrase_index.ORACLE, "op13_filter_audit": filter_audit.ORACLE,
}
