"""The registered queries of the operators, at production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import chat_format, decontaminate, embedding_dedup, mixing, ngram_join, quality, secret_scan, suffix_dedup, token_counts, toxicity
from .common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = mixing.mix_to_targets(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return df.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "kept")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return df.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.rotate(table(spark, sf_dir, "conversations"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_counts, op2_decontamination, op3_ngram_join, op4_toxicity, op5_embedding_dedup, op6_mixing, op7_suffix_dedup, op8_chat_format, op9_quality, op10_secret_scan)}


def oracle_sql() -> dict[str, str]:
    from . import oracles

    return oracles.SQL
