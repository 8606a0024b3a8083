"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granary.llm import line_dedup, mixing, near_dup, ogg, pieces, pii, quality, suffix, token_counts, toxicity


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted(_docs(spark, sf_dir), _labels(spark, sf_dir))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(_docs(spark, sf_dir))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.entities(_docs(spark, sf_dir))


def op4_ogg_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table holds Ogg files, so each page's text is written as one first."""
    return ogg.demuxed(ogg.media_of(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeated_passages(_docs(spark, sf_dir))


def op6_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(_docs(spark, sf_dir), _labels(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed_units(_docs(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_docs(spark, sf_dir))


def op9_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicate_groups(_docs(spark, sf_dir))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(_docs(spark, sf_dir))


_QUERIES = (op1_quality_trees, op2_source_mixing, op3_personal_data, op4_ogg_packets, op5_suffix_dedup, op6_toxic_spans, op7_line_dedup, op8_token_counts, op9_superminhash, op10_sentencepiece)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op2_source_mixing": mixing.SQL, "op4_ogg_packets": ogg.SQL, "op7_line_dedup": line_dedup.SQL}
