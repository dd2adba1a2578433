"""The pipeline's stages, each on its own input, and its result."""

from __future__ import annotations

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm import mixing, queries, quality_rules

from . import plain

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of every stage."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        found = corpus_pipeline.keep(stage(spark, docs, SF_DIR))
        out.append((name, docs, found))
        docs = found
    return out


def test_stages_keep_the_columns_of_documents(steps):
    for _, docs, found in steps[:-1]:
        assert found.schema.simpleString() == steps[0][1].schema.simpleString()
        assert 0 < found.count() <= 2 * docs.count()


def test_rules_stage(steps):
    _, docs, found = steps[0]
    want = {r.doc_id for r in quality_rules.report(docs).collect() if r.kept}
    assert {r.doc_id for r in found.collect()} == want


def test_near_duplicate_stage(steps):
    _, docs, found = steps[1]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in found.collect()) == sorted({c for _, _, c in plain.components(rows, 5, 80)})


def test_passage_stage(steps):
    _, docs, found = steps[2]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {}
    for (i, _), (d, gone) in zip(rows, plain.without_repeated_bytes([t for _, t in rows])):
        want[i] = bytes(x for x, g in zip(d, gone) if not g).decode("utf-8", "ignore")
    assert {r.doc_id: r.text for r in found.collect()} == want
    assert all(r.n_chars == len(r.text) for r in found.collect())


def test_mixing_stage(steps):
    _, docs, found = steps[3]
    want = Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert Counter(r.doc_id for r in found.collect()) == want


def test_token_stage_is_the_result_of_run(spark, steps):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in steps[4][1].collect()}
    rows = steps[4][2].collect()
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, rows))


def test_edges(spark, make_docs, tmp_path):
    """Nulls, empty and long texts, repeated rows and clashing columns pass through all stages."""
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    kept = sorted(r.doc_id for r in quality_rules.accepted(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect())[:12]
    rows = [(i, given[i]) for i in kept]
    rows += [(900, None), (901, ""), (None, None), (None, given[kept[0]]), (902, given[kept[1]]), rows[2], rows[2], (903, " ".join(given[i] for i in kept) * 3)]
    docs = make_docs(rows).withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    current = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        current = corpus_pipeline.keep(stage(spark, current, str(tmp_path)))
        assert current.columns == docs.columns
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} <= set(kept) | {903, None} and found


def test_an_empty_table(spark, make_docs, tmp_path):
    make_docs([]).withColumn("n_chars", F.lit(0).cast("long")).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_a_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
    assert np.all([callable(f) for f in queries.QUERIES.values()])
