"""Queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from tripstar.llm import (bpe, chosen_path, decontaminate, filter_audit, html_text, jaccard, language, perplexity, quality, secrets, sharding,
                          spelling, suffix_dedup)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_suffix_dedup(spark, sf):
    return suffix_dedup.dedup(_table(spark, sf, "documents"))


def op2_html_extraction(spark, sf):
    return html_text.extract(_table(spark, sf, "pages"))


def op3_secret_scan(spark, sf):
    return secrets.scan(_table(spark, sf, "documents"))


def op4_perplexity_rules(spark, sf):
    return perplexity.judge(_table(spark, sf, "documents"))


def op5_extendible_sharding(spark, sf):
    return sharding.assign(_table(spark, sf, "documents"))


def op6_language_id(spark, sf):
    return language.identify(_table(spark, sf, "pages"))


def op7_quality_classifier(spark, sf):
    docs = _table(spark, sf, "documents")
    return quality.score(docs, quality.train(docs, _table(spark, sf, "labels")))


def op8_bpe_round_trip(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digest(bpe.tokenize(_table(spark, sf, "documents"), path))


def op9_ngram_jaccard(spark, sf):
    return jaccard.join(_table(spark, sf, "documents"))


def op10_decontamination(spark, sf):
    return decontaminate.matches(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op11_filter_audit(spark, sf):
    return filter_audit.audit(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op12_chosen_path_dedup(spark, sf):
    return chosen_path.near_duplicates(_table(spark, sf, "documents"))


def op13_spelling_variants(spark, sf):
    return spelling.group(_table(spark, sf, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_suffix_dedup, op2_html_extraction, op3_secret_scan, op4_perplexity_rules, op5_extendible_sharding, op6_language_id, op7_quality_classifier,
        op8_bpe_round_trip, op9_ngram_jaccard, op10_decontamination, op11_filter_audit, op12_chosen_path_dedup,
        op13_spelling_variants)}


def oracle_sql() -> dict[str, str]:
    return {"op5_extendible_sharding": sharding.oracle_sql(), "op11_filter_audit": filter_audit.oracle_sql()}
