"""The registered queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartonwise.llm import (alignment, bpe, infill, language, leaks, lines, near_dup, passages, quality, secret_scan, suffixes, tables,
                            toxicity, urls)

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(tables.documents(spark, sf_dir), tables.read(spark, sf_dir, "labels"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(tables.documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(tables.documents(spark, sf_dir), tables.read(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_later_copies(tables.documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(tables.documents(spark, sf_dir))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.link(tables.documents(spark, sf_dir))


def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(tables.documents(spark, sf_dir), tables.read(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(tables.documents(spark, sf_dir))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(tables.documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), with_ids=False)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(tables.read(spark, sf_dir, "pages"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(tables.documents(spark, sf_dir))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(tables.documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(tables.documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES),
                           with_groups=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_toxicity, op2_secret_scan, op3_quality_rules, op4_line_dedup, op5_substring_dedup, op6_near_duplicates,
    op7_benchmark_leaks, op8_language_id, op9_bpe_round_trip, op10_url_filter, op11_suffix_dedup, op12_fill_in_middle, op13_token_alignment)}

ORACLE_SQL: dict[str, str] = {"op4_line_dedup": lines.ORACLE_SQL, "op12_fill_in_middle": infill.ORACLE_SQL}
