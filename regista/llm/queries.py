"""The operators of this subpackage as queries over the test tables, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regista.llm import (
    decontamination, extraction, importance, language_id, ngram_lm, packing, prefix_trie, rules, sharding, simhash, substrings,
    toxicity, warc,
)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query()
def op1_warc_segment_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


@_query()
def op2_consistent_hash_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


@_query()
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digests(_table(spark, sf_dir, "documents"))


@_query()
def op4_kneser_ney_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(_table(spark, sf_dir, "documents"))


@_query()
def op5_class_conditional_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query()
def op6_text_block_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"))


@_query()
def op7_greedy_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query(rules.ORACLE)
def op8_quality_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(rules.open_ledger(_table(spark, sf_dir, "documents"))).drop("n_lines")


@_query(rules.ABLATIONS_ORACLE)
def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.policy_ablations(rules.open_ledger(_table(spark, sf_dir, "documents")))


@_query()
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query()
def op10_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


@_query()
def op11_prefix_crc_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query(prefix_trie.ORACLE)
def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


@_query()
def op13_language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
