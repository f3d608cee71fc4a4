"""One registered query for each operator of this subpackage, over its whole table, and
DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parallax.llm import (bpe_codec, decontaminate, jaccard_join, language_id, lexical_search, license_scan, line_dedup, lm_scoring,
                          minhash_dedup, quality_rules, token_alignment, token_output, url_filters)
from parallax.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


@query("op1_line_dedup", line_dedup.ORACLE_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(documents(spark, sf_dir))


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(documents(spark, sf_dir))


@query("op3_jaccard_join")
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir), width=3, percent=90)


@query("op4_decontaminate", decontaminate.ORACLE_SQL)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.leaks(documents(spark, sf_dir), items)


@query("op5_lm_scoring")
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return lm_scoring.report(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


@query("op6_url_filters", url_filters.ORACLE_SQL)
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.report(spark, sf_dir)


@query("op7_token_output")
def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.report(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_bpe_codec")
def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_codec.digests(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(documents(spark, sf_dir))


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(documents(spark, sf_dir))


@query("op11_lexical_search", lexical_search.ORACLE_SQL)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return lexical_search.search(documents(spark, sf_dir), items, k=50)


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_minhash_dedup")
def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir), width=3, percent=85)
