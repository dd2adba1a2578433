"""op2 and op7 against direct Python, with few pieces of a key allowed and with many."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import substring_dedup, suffix_array_dedup, windows
from ledgerloom.llm.arrays import chunks
from ledgerloom.llm.windows import Units

from . import plain


def prose(rng, n):
    return [rng.choice("ab abc de fgh ij klm no pq rst uvw".split()) + str(rng.randrange(60)) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    """Passages in many documents, near and exact copies, periodic and edge texts."""
    rng = random.Random(4)
    passages = [prose(rng, n) for n in (25, 60, 21, 19, 45)]
    out = []
    for i in range(90):
        body = prose(rng, rng.randrange(0, 120))
        for p in rng.sample(passages, rng.randrange(0, 3)):
            at = rng.randrange(len(body) + 1)
            body[at:at] = p
        if i % 9 == 0 and out:
            body = plain.words(out[rng.randrange(len(out))][1])
            if body and i % 2:
                body[rng.randrange(len(body))] = "changed"
        out.append((i, rng.choice([" ", "  ", "\n"]).join(body)))
    out += [
        (200, None), (201, ""), (202, " \t "), (203, "x " * 500), (204, "ab" * 4000), (205, "é…" * 150),
        (None, out[5][1]), (None, None), out[7], out[7], (out[8][0], "another text " * 30), (-3, out[9][1]),
        (206, " ".join(passages[1]) + " " + " ".join(passages[1])), (207, " ".join(prose(rng, 4000))),
    ]
    return out


@pytest.mark.parametrize("pieces", [windows.MAX_PIECES, 3, 1])
def test_both(make_docs, rows, monkeypatch, pieces):
    """With many pieces of a key allowed, with few, and with one: all are dealt out to the last."""
    monkeypatch.setattr(windows, "MAX_PIECES", pieces)
    docs = make_docs(rows).repartition(5)
    got = [tuple(r) for r in suffix_array_dedup.report(docs).collect()]
    assert sorted(got, key=repr) == plain.repeated_bytes(rows)
    # documents of equal id and different texts have an order of their own: leave them out here
    some = [r for r in rows if r[0] is not None and r != (8, "another text " * 30)]
    got = [tuple(r) for r in substring_dedup.report(make_docs(some).repartition(5)).collect()]
    assert sorted(got, key=repr) == plain.repeated_words(some)


def test_a_key_with_thousands_of_pieces(make_docs):
    """One rare-hashed phrase in the middle of 3,000 different surroundings, some of them shared."""
    rng = random.Random(6)
    phrase = "the one phrase that all of them have in common".split()
    sides = [prose(rng, 14) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(sides)[: rng.randrange(5, 15)] + phrase + rng.choice(sides)[: rng.randrange(5, 15)])) for i in range(3000)]
    got = [tuple(r) for r in substring_dedup.report(make_docs(rows)).collect()]
    assert sorted(got, key=repr) == plain.repeated_words(rows)
    some = rows[:900]
    got = [tuple(r) for r in suffix_array_dedup.report(make_docs(some)).collect()]
    assert sorted(got, key=repr) == plain.repeated_bytes(some)


def test_empty_table(make_docs):
    docs = make_docs([])
    assert suffix_array_dedup.report(docs).count() == 0
    assert substring_dedup.report(docs).count() == 0


def test_shortened_documents_keep_their_columns(make_docs, rows):
    docs = make_docs(rows[:20])
    out = suffix_array_dedup.shortened(docs)
    assert out.columns == docs.columns
    flags = plain.without_repeated_bytes([t for _, t in rows[:20]])
    want = sorted((i, bytes(x for x, g in zip(d, gone) if not g).decode("utf-8", "ignore"))
                  for (i, _), (d, gone) in zip(rows[:20], flags))
    assert sorted((r.doc_id, r.text) for r in out.collect()) == want
    assert substring_dedup.shortened(docs).columns == docs.columns
    some = [r for r in rows[:20] if r[1] is not None]
    out = substring_dedup.shortened(make_docs(some).withColumn("n_chars", F.lit(-1))).collect()
    assert {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in out} == {(w[0], w[3]) for w in plain.repeated_words(some)}
    assert all(r.n_chars == len(r.text) for r in out)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=24), min_size=1, max_size=6))
def test_run_length_index_gives_the_longest_match_elsewhere(pieces):
    (chunk,) = chunks(pa.array([p.encode() for p in pieces], pa.binary()), 1 << 40)
    units = Units(chunk, words=False)
    index = suffix_array_dedup.RunLengthIndex.build(units.values, units.bounds, units.data)
    assert index.length.sum() == index.n == sum(map(len, pieces)) + len(pieces)
    reach = index.match_ends() - np.arange(index.n)
    places = [(i, j) for i, p in enumerate(pieces) for j in range(len(p))]

    def common(a, b):
        x, y = pieces[a[0]][a[1]:], pieces[b[0]][b[1]:]
        return next((k for k, (s, t) in enumerate(zip(x, y)) if s != t), min(len(x), len(y)))

    want = [max([common(p, q) for q in places if q != p], default=0) for p in places]
    got = [reach[chunk.bounds[i] + j + i] for i, j in places]
    assert got == want


@given(st.lists(st.integers(0, 2), max_size=40))
def test_automaton_gives_the_longest_suffix_that_ended_before(words):
    automaton = substring_dedup.SuffixAutomaton()
    for i, word in enumerate(words):
        got = automaton.add(word)
        want = max(n for n in range(i + 1) if n == 0 or any(
            words[j - n: j] == words[i + 1 - n: i + 1] for j in range(n, i + 1)))
        assert got == want
