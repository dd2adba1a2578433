"""One query per operator over its whole table, and the same results in DuckDB SQL where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe,
    hard_negatives,
    lm_scores,
    mixing,
    mtree_search,
    ngram_jaccard,
    personal_data,
    quality_classifier,
    quality_rules,
    spelling,
    substring_dedup,
    suffix_array_dedup,
    toxicity,
)
from .shared import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.report(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree_search.report(table(spark, sf_dir, "embeddings"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup.report(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.report(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.report(table(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.report(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_toxicity": op5_toxicity,
    "op6_exact_topk": op6_exact_topk,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_bpe": op8_bpe,
    "op9_lm_scores": op9_lm_scores,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_pii": op11_pii,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES: dict[str, str] = {
    "op9_lm_scores": lm_scores.oracle_sql(),
    "op1_mix_sources": mixing.oracle_sql(),
    "op3_quality_rules": quality_rules.oracle_sql(),
    "op6_exact_topk": mtree_search.oracle_sql(),
    "op10_ngram_jaccard": ngram_jaccard.oracle_sql(),
    "op12_spelling_variants": spelling.oracle_sql(),
    "op13_hard_negatives": hard_negatives.oracle_sql(),
}
