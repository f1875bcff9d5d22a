"""The queries of this subpackage over the given tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lamina.llm import bpe, byte_dedup, decontaminate, fill_middle, license_scan, main_text, ngram_join, preferences, private_spans, quality_votes, secret_scan, whitening, word_dedup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op2_word_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.preference_examples(table(spark, sf_dir, "conversations"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_spans.digest(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_votes.report(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_byte_dedup": op1_byte_dedup, "op2_word_dedup": op2_word_dedup, "op3_preferences": op3_preferences, "op4_ngram_join": op4_ngram_join, "op5_licenses": op5_licenses, "op6_private": op6_private, "op7_quality": op7_quality, "op8_bpe": op8_bpe, "op9_secrets": op9_secrets, "op10_decontaminate": op10_decontaminate, "op11_whitening": op11_whitening, "op12_main_text": op12_main_text, "op13_fill_middle": op13_fill_middle}


def oracle_sql() -> dict[str, str]:
    return {"op3_preferences": preferences.ORACLE, "op13_fill_middle": fill_middle.ORACLE}
