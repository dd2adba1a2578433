"""Spelling variants against comparing every two words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from ledgerloom.llm import spelling

A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=repr)


def damaged(rng, word):
    at = rng.randrange(len(word))
    return rng.choice([word[:at] + word[at + 1:], word[:at] + rng.choice("abyzéÿ×") + word[at + 1:], word[:at] + rng.choice("azßÀ") + word[at:]])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeéÉñxyz", k=rng.randint(5, 9))) for _ in range(40)] + ["aaaaaaa", "aaaaaaaa", "l" * 70, "l" * 71, "ab" * 3000]
    pool = {w: 2 ** rng.randint(2, 9) if len(w) < 100 else 6 for w in words}
    for w in words:
        for _ in range(4):
            v = damaged(rng, w)
            pool.setdefault(v, rng.choice([4, 5, 6, 20]))
            pool.setdefault(damaged(rng, v), 5)
    tokens = [w for w, n in pool.items() for _ in range(n)]
    rng.shuffle(tokens)
    texts = [" ".join(t if rng.random() < 0.7 else t.upper() if t.isascii() else t for t in tokens[i: i + 60]) for i in range(0, len(tokens), 60)]
    return [*enumerate(texts), (None, "wordless wordless 12wordless3wordless-wordless"), (7, None), (8, ""), (9, texts[0]), (9, texts[0])]


@pytest.mark.parametrize("parts", [spelling.ROUND_PARTS, 3])
def test_variants(spark, make_docs, rows, parts):
    found = spelling.variants(make_docs(rows), parts)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_variants(rows)


def test_small_parts(spark, make_docs, rows):
    """Filters of several parts each, probed in rounds."""
    words = spelling.keep(spelling.vocabulary(make_docs(rows)))
    pairs = {tuple(sorted((r["word_a"], r["word_b"]))) for r in spelling.near_pairs(words, 20, part_blocks=4, bits=1500).collect()}
    n = [r["word"] for r in words.collect()]
    assert pairs == {(a, b) for a in n for b in n if a < b and one_edit(a, b)}


def test_nothing_frequent(spark, make_docs):
    assert spelling.variants(make_docs([])).collect() == []
    assert spelling.variants(make_docs([(1, "seldom words here"), (2, None)])).collect() == []


def test_long_chain_of_forms(spark, make_docs):
    """Roots several steps away."""
    words = ["chainlink", "chainlin", "chainli", "chainl"]
    rows = [(None if i == 0 else i, " ".join([w] * n)) for i, (w, n) in enumerate(zip(words, (6, 40, 220, 1300)))]
    found = {r["word"]: r["root"] for r in spelling.variants(make_docs(rows)).collect()}
    assert found == {r[0]: r[2] for r in plain_variants(rows)}
    assert found["chainlink"] == "chainl"
