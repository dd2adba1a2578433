"""op4, op5 and op9: fitted or counted over the corpus."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import lm_scores, quality_classifier, toxicity
from ledgerloom.llm.arrays import chunks
from ledgerloom.llm.quality_classifier import ABSTAIN, BAD, GOOD

SF = "/root/testdata/sf{}"
EDGES = [(1, None), (2, ""), (3, " \n"), (4, "word"), (4, "word"), (None, "word two"), (5, "x y " * 20_000), (6, "é!")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(SF.format("0.1") + "/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(SF.format("0.1") + "/labels.parquet")


def test_label_model_finds_accuracies_it_was_made_with():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.7
    right = [0.95, 0.8, 0.9, 0.7, 0.85]
    pattern = np.zeros(len(good), dtype=np.int64)
    for p in right:
        vote = np.where((rng.random(len(good)) < p) == good, GOOD, BAD)
        pattern = 3 * pattern + np.where(rng.random(len(good)) < 0.1, ABSTAIN, vote)
    some, count = np.unique(pattern, return_counts=True)
    model = quality_classifier.fit_labels(some, count.astype(float), len(right), precise=False)
    assert np.abs(model.accuracies() - right).max() < 0.03
    assert abs(model.good - 0.7) < 0.03
    assert ((model.posterior(pattern) > 0.5) == good).mean() > 0.93


def plain_em(rows, precise):
    """The same expectation-maximisation, vote by vote: rows are tuples of votes."""
    size = len(rows[0])
    good, votes = 0.8, [[[0.1, 0.3, 0.6], [0.08, 0.02, 0.9]] for _ in range(size)]

    def chance(row):
        side = [1 - good, good]
        for k, vote in enumerate(row):
            side = [side[c] * votes[k][c][vote] for c in (0, 1)]
        return side[1] / (side[0] + side[1])

    for _ in range(quality_classifier.ROUNDS):
        belief = [chance(row) for row in rows]
        tables = [[[1.0] * 3 for _ in range(2)] for _ in range(size)]
        for row, b in zip(rows, belief):
            for k, vote in enumerate(row):
                tables[k][0][vote] += 1 - b
                tables[k][1][vote] += b
        good = (sum(belief) + 1) / (len(rows) + 2)
        votes = [[[n / sum(side) for n in side] for side in table] for table in tables]
        if precise:
            for table in votes:
                over = max(table[1][BAD] - quality_classifier.FALSE_ALARMS, 0)
                table[1][BAD] -= over
                table[1][GOOD] += over
    return good, votes, [chance(row) for row in rows]


@pytest.mark.parametrize("precise", [True, False])
def test_label_model_against_plain_expectation_maximisation(precise):
    rng = np.random.default_rng(7)
    truth = rng.random(300) < 0.75
    rows = [tuple(int(v) for v in rng.choice(3, size=4, p=[0.15, 0.05, 0.8] if t else [0.2, 0.5, 0.3])) for t in truth]
    pattern = np.array([int("".join(map(str, r)), 3) for r in rows])
    some, count = np.unique(pattern, return_counts=True)
    model = quality_classifier.fit_labels(some, count.astype(float), 4, precise=precise)
    good, votes, belief = plain_em(rows, precise)
    assert model.good == pytest.approx(good, abs=1e-9)
    assert model.votes == pytest.approx(np.array(votes), abs=1e-9)
    assert model.posterior(pattern) == pytest.approx(np.array(belief), abs=1e-9)
    if precise:
        assert model.votes[:, 1, BAD].max() <= quality_classifier.FALSE_ALARMS + 1e-12


def test_network_against_a_plain_loop():
    """Forward pass: every filter at every place, the largest response, then the output."""
    rng = np.random.default_rng(5)
    model = toxicity.Cnn.untrained(9)
    model.bias[:] = rng.normal(0, 0.2, len(model.bias))
    sizes = [1, 2, 3, 7, 20]
    pad = max(toxicity.WIDTHS) - 1
    first, second, begins = [], [], [0]
    for size in sizes:
        for rows in (first, second):
            rows += [int(x) for x in rng.integers(0, toxicity.PAD, size)] + [toxicity.PAD] * pad
        begins.append(len(first))
    got = model.pooled(np.array(first), np.array(second), np.array(begins))
    for d in range(len(sizes)):
        words = [np.concatenate([model.tables[0][first[i]], model.tables[1][second[i]]]) for i in range(begins[d], begins[d + 1])]
        column = 0
        for k, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                best = 0.0
                for at in range(len(words)):
                    total = model.bias[k * toxicity.FILTERS + f]
                    for offset in range(min(width, len(words) - at)):
                        total += words[at + offset] @ model.filters[:, column + offset * toxicity.FILTERS + f]
                    best = max(best, total)
                assert got[d, k * toxicity.FILTERS + f] == pytest.approx(best, abs=1e-4)
            column += width * toxicity.FILTERS
        want = 1 / (1 + np.exp(-(got[d] @ model.out + model.out_bias)))
        assert model.score(got)[d] == pytest.approx(want, abs=1e-6)


def test_quality_scores_agree_with_labels_never_seen(docs, labels):
    rows = quality_classifier.report(docs).join(labels, "doc_id").select("quality", "kept").toPandas()
    assert rows.kept[rows.quality == 1].mean() > 0.97
    assert rows.kept[rows.quality == 0].mean() < 0.05


def test_quality_edges(make_docs):
    got = quality_classifier.report(make_docs(EDGES)).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((d for d, _ in EDGES), key=repr)
    assert all(0 <= r.score <= 1 and 0 <= r.weak_label <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert quality_classifier.report(make_docs([])).count() == 0


def test_toxicity_on_the_held_out_third(docs, labels):
    rows = toxicity.report(docs, labels).join(labels, "doc_id").toPandas()
    assert all(rows.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id])
    assert all((rows.score >= 0.7) == (rows.predicted == 1)) and rows.score.between(0, 1).all()
    rows = rows[rows.held_out]
    toxic = rows.toxic == 1
    # some 300 toxic documents to learn from; with 1,400 it finds nine in ten
    assert rows.predicted[toxic].mean() > 0.5
    assert rows.predicted[~toxic].mean() < 0.02
    order = rows.score.rank()
    auc = (order[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.88


def test_scores_do_not_depend_on_neighbours(make_docs, spark):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(3, 40)], "doc_id long, quality int, toxic int")
    rows = [(i, f"w{i % 2} w{i} " * (i % 5 + 1)) for i in range(40)]
    a = {r.doc_id: r.score for r in toxicity.report(make_docs(rows).coalesce(1), labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.report(make_docs(rows[::-1]).repartition(7), labels).collect()}
    assert a == pytest.approx(b, abs=1e-6)


def test_flags_hold_on_rows_never_fitted(docs, labels):
    """False alarms of calibrated flags outside the sample are near those on the calibration rows."""
    rows = toxicity.report(docs, labels).join(labels, "doc_id").toPandas()
    clean = rows[rows.held_out & (rows.toxic == 0)]
    assert clean.flagged.mean() < 0.02


def test_toxicity_never_uses_held_out_labels(spark):
    docs = spark.read.parquet(SF.format("0.001") + "/documents.parquet")
    labels = spark.read.parquet(SF.format("0.001") + "/labels.parquet")
    other = labels.withColumn("toxic", (toxicity.held_out(labels.doc_id).cast("int") + (1 - 2 * toxicity.held_out(labels.doc_id).cast("int")) * labels.toxic).cast("int"))
    first = sorted(map(tuple, toxicity.report(docs, labels).select("doc_id", "score").collect()))
    assert first == sorted(map(tuple, toxicity.report(docs, other).select("doc_id", "score").collect()))
    # nor lang or source
    bare = docs.withColumn("lang", docs.source)
    assert first == sorted(map(tuple, toxicity.report(bare, labels).select("doc_id", "score").collect()))


def test_toxicity_edges(spark, make_docs):
    schema = "doc_id long, quality int, toxic int"
    docs = make_docs(EDGES)
    none = spark.createDataFrame([], schema)
    assert {r.score for r in toxicity.report(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(1, 0, 1), (2, 0, None), (None, 0, 1), (99, 1, 0)], schema)
    assert len({r.score for r in toxicity.report(docs, one).collect()}) == 1
    both = spark.createDataFrame([(i, 0, i % 2) for i in range(1, 7)] + [(4, 0, 1)], schema)
    got = toxicity.report(docs, both).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert toxicity.report(make_docs([]), both).count() == 0


def test_toxicity_learns_from_every_labelled_text(make_docs, spark, monkeypatch):
    """Long texts too, and in several parts."""
    monkeypatch.setattr(toxicity, "PART_ROWS", 60)
    rows = [(i, f"w{i % 7} plain words here " * 1100 + "vile nasty thing " * 20 * (i % 3 == 0)) for i in range(300)]
    assert min(len(t) for _, t in rows) > 20_000
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    got = toxicity.report(make_docs(rows), labels).where("held_out").collect()
    assert min(r.score for r in got if r.doc_id % 3 == 0) > max(r.score for r in got if r.doc_id % 3)
    assert all((r.doc_id % 3 == 0) == bool(r.predicted) == r.flagged for r in got)


def test_packed_words_and_their_parameters_come_back():
    chunk = next(chunks(pa.array(["one two", None, "", "three four five six"])))
    first, second, begins = toxicity.word_rows(chunk)
    packed = (first << toxicity.BITS | second)[first != toxicity.PAD]
    again = toxicity.padded([packed[:2], packed[:0], packed[:0], packed[2:]])
    for a, b in zip(again, (first, second, begins), strict=True):
        assert a.tolist() == b.tolist()
    arrays = toxicity.Cnn.untrained(4).parameters()
    for a, b in zip(toxicity._unflat(toxicity._flat(arrays), arrays), arrays, strict=True):
        assert a.tolist() == b.tolist()


def test_thresholds_match_a_plain_search(spark):
    rng = np.random.default_rng(2)
    rows = [(("en", "de", None, "xx")[i % 4 if i < 900 else 3], int(rng.random() < 0.3), float(rng.integers(1, 200)) / 200) for i in range(910)]
    rows = [(lang, label, min(0.999, score * (0.6 + 0.5 * label))) for lang, label, score in rows if lang != "xx" or not label]
    got = toxicity.thresholds(spark.createDataFrame(rows, "lang string, label int, score double"))

    def plain(some):
        scores = sorted({s for _, _, s in some}, reverse=True)
        toxic = sum(label for _, label, _ in some)
        f1 = [2 * sum(label for _, label, s in some if s >= t) / (sum(s >= t for _, _, s in some) + toxic) for t in scores]
        at = f1.index(max(f1))
        return (scores[at] + [*scores, 0.0][at + 1]) / 2

    want = {None: plain(rows)} | {x: plain([r for r in rows if r[0] == x]) for x in ("en", "de")}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("small", [False, True])
def test_lm_scores_match_duckdb(spark, duck, monkeypatch, small):
    if small:  # many buckets and partitions
        monkeypatch.setattr(lm_scores, "BUCKET_BYTES", 20_000)
        monkeypatch.setattr(lm_scores, "PART_GRAMS", 3_000)
    path = SF.format("0.001") + "/documents.parquet"
    rows, columns = duck(lm_scores.oracle_sql(), documents=path)
    df = lm_scores.report(spark.read.parquet(path))
    assert df.columns == columns
    assert sorted(map(tuple, df.collect()), key=repr) == rows


def test_lm_edges(make_docs, duck):
    got = sorted(map(tuple, lm_scores.report(make_docs(EDGES)).collect()), key=repr)
    import pandas as pd

    rows, _ = duck(lm_scores.oracle_sql(), documents=pd.DataFrame(
        {"doc_id": pd.array([d for d, _ in EDGES], dtype="Int64"), "text": [t for _, t in EDGES]}))
    assert got == rows
    assert lm_scores.report(make_docs([])).count() == 0
