"""The registered queries of this subpackage: name -> callable(spark, sf_dir), and DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    dac, decontaminate, divergence, line_dedup, manifest, minhash, packing, pii, quality_model, quality_rules,
    secret_scan, shard, sql, sql_audit, substring_dedup,
)
from tidemark.llm.common import documents


def op1_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(documents(spark, sf_dir))


def op2_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op3_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op4_rule_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op6_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied")


def op7_addressable_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.read(spark, dac.write(documents(spark, sf_dir)))


def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard_rows(documents(spark, sf_dir))


def op9_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(documents(spark, sf_dir))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_skip_chain_pii": op1_skip_chain_pii,
    "op2_minhash_bayes": op2_minhash_bayes,
    "op3_rule_ensemble": op3_rule_ensemble,
    "op4_rule_votes": op4_rule_votes,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_secret_ownership": op6_secret_ownership,
    "op7_addressable_codes": op7_addressable_codes,
    "op8_feistel_shards": op8_feistel_shards,
    "op9_seed_extend": op9_seed_extend,
    "op10_positional_index": op10_positional_index,
    "op11_source_divergence": op11_source_divergence,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_line_dedup": op13_line_dedup,
}

ORACLES: dict[str, str] = {
    "op2_minhash_bayes": sql.near_duplicates(),
    "op4_rule_votes": sql.rule_votes(),
    "op6_secret_ownership": sql.secrets(),
    "op8_feistel_shards": sql.shards(),
    "op9_seed_extend": sql.substring_dedup(),
    "op10_positional_index": sql.contamination(),
    "op11_source_divergence": sql_audit.divergences(),
    "op12_merkle_manifest": sql_audit.merkle(),
    "op13_line_dedup": sql_audit.line_dedup_sql(),
}
