"""Registered queries of the subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.llm import (binary_output, ego_join, filter_audit, fingerprints, importance, language_id, license_scan,
                           line_dedup, mixing, ngram_join, packing, quality_rules, secret_scan)
from lodgeflow.llm.oracle import ORACLE_SQL  # noqa: F401
from lodgeflow.llm.shared import read
from lodgeflow.session import shared_dir


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return packing.pack_digest(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(read(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op4_ego_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.linked(read(spark, sf_dir, "embeddings"), 0.95)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_digest(secret_scan.scan(read(spark, sf_dir, "documents")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(read(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    domain = F.when(labels["toxic"] == 1, "toxic").when(labels["quality"] == 0, "low").otherwise("clean")
    return mixing.mixed(read(spark, sf_dir, "documents"), labels.select("doc_id", domain.alias("domain")),
                        {"clean": 0.9, "low": 0.07, "toxic": 0.03})


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(read(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "llm-token-ids")
    binary_output.write_ids(read(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return binary_output.read_ids(spark, path).select(
        "doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.deduplicated(read(spark, sf_dir, "documents")))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_fingerprints": op2_fingerprints,
    "op3_license_scan": op3_license_scan,
    "op4_ego_join": op4_ego_join,
    "op5_secret_scan": op5_secret_scan,
    "op6_language_id": op6_language_id,
    "op7_mixing": op7_mixing,
    "op8_ngram_join": op8_ngram_join,
    "op9_quality_rules": op9_quality_rules,
    "op10_binary_output": op10_binary_output,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_line_dedup": op12_line_dedup,
    "op13_filter_audit": op13_filter_audit,
}
