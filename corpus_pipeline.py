"""Corpus preparation: each stage reads all that the stage before it kept.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet in the shared folder and reads it again as the next stage's documents. The tables belong to
the caller: ``ledgerloom.session.remove_scratch`` deletes them when the result is written.

Defined results: every stage but the last returns the columns it got, whatever they are called. Null
and empty texts fail the rules, so they go first. A null doc_id is an id of its own; of near
duplicates the smallest doc_id stays, a null one only among null ones. Rows equal in doc_id and text
stay as often as they are there, and passages that they share are then repeated passages. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, mixing, ngram_jaccard, quality_rules, suffix_array_dedup
from ledgerloom.llm.shared import keep, table

#: Near duplicates among documents: sets of five-word runs, similarity of 0.8 or more.
NEAR = ngram_jaccard.Measure(gram=5, percent=80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all rules."""
    return quality_rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id."""
    return ngram_jaccard.representatives(docs, NEAR)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that occur anywhere else."""
    return suffix_array_dedup.shortened(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source at its target weight: documents repeated or left out, in shuffled order."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of the text they decode to."""
    found = bpe.tokenized(docs.select("doc_id", "source", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_jaccard", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("mix_sources", mix),
    ("bpe", tokens),
]
#: Several stages have no SQL form; tests hold the result against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
