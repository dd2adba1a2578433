"""op10, connected components and op6 against direct Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerloom.llm import mtree_search, ngram_jaccard
from ledgerloom.llm.components import components

from . import plain


@pytest.fixture(scope="module")
def rows():
    """Copies with more and more changes, shared passages, chains of links, and edges."""
    rng = random.Random(9)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([5, 8, 40, 90, 150]))] for _ in range(14)]
    passage = [f"p{i}" for i in range(30)]
    out = []
    for b in base:
        current = list(b)
        for _ in range(rng.randrange(1, 9)):
            out.append((len(out), " ".join(current)))
            for _ in range(rng.choice([0, 1, 1, 2])):
                current[rng.randrange(len(current))] = f"c{rng.randrange(5000)}"
        out.append((len(out), " ".join(b + passage)))
        out.append((len(out), " ".join(rng.choices([f"q{i}" for i in range(300)], k=20) + passage)))
    out += [
        (900, None), (901, ""), (902, " \t\n"), (903, "one two"), (904, "One  TWO"), (905, "one two three"),
        (906, "É A"), (907, "é a"), (None, out[3][1]), (None, "nobody else says this at all"), (None, None),
        out[5], (out[5][0], "a text of its own under a known id"), (-7, out[20][1]), (908, "z " * 5000),
        (909, " ".join(f"l{i}" for i in range(6000))), (910, " ".join(f"l{i}" for i in range(100, 6100))),
    ]
    return out


@pytest.mark.parametrize("hot, gram, percent", [(8, 4, 85), (2, 4, 85), (3, 5, 80), (10_000, 1, 50)])
def test_components_of_links(make_docs, rows, monkeypatch, hot, gram, percent):
    monkeypatch.setattr(ngram_jaccard, "HOT", hot)
    measure = ngram_jaccard.Measure(gram, percent)
    got = ngram_jaccard.memberships(make_docs(rows).repartition(4), measure).selectExpr(
        f"nullif(_d, {-2**63}) AS doc_id", "n", "_component").collect()
    assert sorted(map(tuple, got), key=repr) == plain.components(rows, gram, percent)


def near_copies(count, size, most, seed):
    """Texts with a few words changed, most pairs of them too far apart to link."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(size)]
    out = []
    for i in range(count):
        words = list(base)
        for _ in range(rng.randrange(most + 1)):
            words[rng.randrange(size)] = f"n{rng.randrange(60)}"
        out.append((i, " ".join(words[: size - rng.choice([0, 0, 0, 9])])))
    return out


@pytest.mark.parametrize("size, most, gram, percent", [(60, 6, 4, 85), (150, 8, 4, 85), (150, 14, 5, 80), (25, 3, 4, 85), (40, 4, 1, 85)])
def test_a_large_group_of_near_copies(make_docs, size, most, gram, percent):
    rows = near_copies(220, size, most, size + most)
    rows += [(1000 + i, t) for i, t in near_copies(60, size - 3, most, 5)]
    got = ngram_jaccard.memberships(make_docs(rows), ngram_jaccard.Measure(gram, percent)).select("_d", "n", "_component").collect()
    want = plain.components(rows, gram, percent)
    assert len({c for _, _, c in want}) > 3
    assert sorted(map(tuple, got), key=repr) == want


@pytest.mark.parametrize("bits", [3, 6])
def test_classes_of_one_short_name(make_docs, rows, bits):
    got = ngram_jaccard.memberships(make_docs(rows), bits=bits).selectExpr(f"nullif(_d, {-2**63}) AS doc_id", "n", "_component")
    assert sorted(map(tuple, got.collect()), key=repr) == plain.components(rows)


def test_texts_of_shared_phrases(make_docs):
    """Every n-gram is frequent and no two texts link: few pairs are compared."""
    rng = random.Random(8)
    phrases = [" ".join(f"p{i}w{j}" for j in range(12)) for i in range(60)]
    rows = [(i, " ".join(rng.sample(phrases, 8))) for i in range(400)]
    got = ngram_jaccard.memberships(make_docs(rows)).select("_d", "n", "_component").collect()
    assert sorted(map(tuple, got), key=repr) == plain.components(rows)


def test_texts_far_from_their_group_meet_few(make_docs, monkeypatch):
    """Copies of one text with words of their own: those changed too much to link are not compared
    with the rest of the group, whatever its size."""
    rng, rows = random.Random(4), []
    for i in range(240):
        words = [f"b{j}" for j in range(300)]
        for at in rng.sample(range(300), rng.choice([0, 1, 2, 9, 11, 13, 15])):
            words[at] = f"d{i}x{at}"
        rows.append((i, " ".join(words)))
    # as in a large table, whose buckets hold so many n-grams that none stands out
    monkeypatch.setattr(ngram_jaccard, "frequency_levels", lambda *_: np.zeros(1 << ngram_jaccard.BUCKETS, dtype=np.uint8))
    links, compared = ngram_jaccard._links, []
    monkeypatch.setattr(ngram_jaccard, "_links", lambda pairs, *more: compared.append(pairs.count()) or links(pairs, *more))
    got = ngram_jaccard.memberships(make_docs(rows)).select("_d", "n", "_component").collect()
    want = plain.components(rows)
    assert len({c for _, _, c in want}) > 100
    assert sorted(map(tuple, got), key=repr) == want
    assert sum(compared) < 5 * len(rows)


def test_report_and_empty_table(make_docs, rows):
    df = ngram_jaccard.report(make_docs(rows))
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, df.collect()), key=repr) == plain.components(rows)
    assert ngram_jaccard.report(make_docs([])).count() == 0


def test_one_document_of_each_group_stays(make_docs, rows):
    rows = [r for r in rows if r[0] is not None and rows.count(r) == 1 and r[0] != rows[5][0]]
    docs = make_docs(rows)
    out = ngram_jaccard.representatives(docs)
    assert out.columns == docs.columns
    want = sorted({c for _, _, c in plain.components(rows)})
    assert sorted(r.doc_id for r in out.collect()) == want


def test_components_of_a_star_a_path_and_loops(spark):
    links = [(0, i) for i in range(1, 200)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000), (7, 3), (3, 7)]
    df = components(spark.createDataFrame(links, "x long, y long"))
    got = {r.node: r.component for r in df.collect()}
    assert got == {**{i: 0 for i in range(200)}, **{i: 1000 for i in range(1000, 1061)}}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0
    some = components(spark.createDataFrame([(1, None), (None, 2), (None, None), (3, 4)], "x long, y long"))
    assert sorted(map(tuple, some.collect())) == [(3, 3), (4, 3)]


def test_rounds_leave_one_table(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("ledgerloom.llm.shared.shared_dir", lambda _: str(tmp_path))
    assert components(spark.createDataFrame([(i, i + 1) for i in range(40)], "x long, y long")).count() == 41
    assert len(list(tmp_path.iterdir())) == 1


SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("cell", T.StringType()), T.StructField("tree", T.StringType()), T.StructField("hits", T.StringType()),
])


def nearest(rows, k=20):
    valid = [(i, [math.floor(64 * v) for v in x]) for i, x in rows
             if i is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)]
    out = []
    for at, (q, x) in enumerate(valid):
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for j, (i, y) in enumerate(valid) if j != at and len(y) == len(x))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("tree_rows, page_rows, sample, group", [(4096, 48, 2048, 8), (40, 4, 25, 3), (10, 4, 60, 1)])
def test_top_k(spark, monkeypatch, tree_rows, page_rows, sample, group):
    monkeypatch.setattr(mtree_search, "GROUP_TREES", group)
    monkeypatch.setattr(mtree_search, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(mtree_search, "PAGE_ROWS", page_rows)
    monkeypatch.setattr(mtree_search, "SAMPLE", sample)
    rng = np.random.default_rng(2)
    centers = rng.normal(0, 1, (6, 8))
    rows = [(i, (centers[i % 6] + rng.normal(0, 0.2, 8)).round(2).tolist()) for i in range(400)]
    rows += [(1000 + i, [0.5] * 8) for i in range(90)]  # equal vectors: ties and a hot group
    rows += [(1020, [0.5] * 8)] * 30 + [(60, [0.5] * 8), (60, [0.25] * 8), (60, rows[60][1])]  # equal rows and ids
    rows += [(2000, None), (2020, [None] * 8), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8), (None, [1.0] * 8),
             (2080, []), (2081, []), (2100, [1.0, 2.0]), (2101, [3.0, -1.0]), (40, rows[40][1]), (-20, [0.25] * 8), (20, [9.0] * 8)]
    df = spark.createDataFrame([(i, x, "a", "b", "c") for i, x in rows], SCHEMA)
    stored = [(r.vec_id, r.embedding) for r in df.collect()]
    got = mtree_search.top_k(df.repartition(3)).collect()
    assert sorted(map(tuple, got)) == nearest(stored)


def test_top_k_of_nothing_and_of_one(spark):
    assert mtree_search.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mtree_search.top_k(spark.createDataFrame([(20, [1.0], "", "", "")], SCHEMA)).count() == 0


def test_whole_table_against_duckdb(spark, duck):
    path = "/root/testdata/sf0.01/embeddings.parquet"
    rows, columns = duck(mtree_search.oracle_sql(), embeddings=path)
    got = mtree_search.report(spark.read.parquet(path))
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=repr) == rows


def test_trees_that_cannot_hold_a_result_are_not_searched(spark, monkeypatch):
    """Far clusters: what the first tree found keeps a query out of the others."""
    monkeypatch.setattr(mtree_search, "TREE_ROWS", 60)
    monkeypatch.setattr(mtree_search, "GROUP_TREES", 1)
    asked = []
    before = mtree_search._asked
    monkeypatch.setattr(mtree_search, "_asked", lambda q, *rest: asked.append(q.count()) or before(q, *rest))
    rng = np.random.default_rng(3)
    centers = np.eye(12) * 40
    rows = [(i, (centers[i % 12] + rng.normal(0, 0.1, 12)).tolist()) for i in range(1200)]
    df = spark.createDataFrame([(i, x, "", "", "") for i, x in rows], SCHEMA)
    got = mtree_search.top_k(df).collect()
    assert sorted(map(tuple, got)) == nearest([(r.vec_id, r.embedding) for r in df.collect()])
    assert asked[0] == 60 and asked[1] <= 4 * 60
