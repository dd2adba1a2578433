"""op8 against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TRICKY = [
    "", " ", "Hello World", "it's we'll I'M they'd 've", "a" * 300, "haha" * 99, "<|endoftext|>", "x<|startoftext|>y <|endoftext",
    "ΣΑΣ σας ΟΔΟΣ", "İstanbul", "é Å ﬁ", "12345 ½ Ⅷ ٣", "日本語 テスト 中文", "a b c　d\x85e\x1cf\x1fg",
    "!!!??... --- $%&", "🙂👍🏽 zwj 👩‍👩‍👧", "tab\there\nnew\r\nline\x0bv\x0cf", "\x00\x01", "naïve façade",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_tricky_and_random_texts(library):
    mine, rng = bpe.tokenizer(PATH), random.Random(3)
    pool = list("abcdefghijklmnopqrstuvwxyzABC' \t\n<|>0123.,!ééßΣσİ…") + ["the", "ing", "tion", "<|endoftext|>", "'s", "\x1c", " "]
    texts = TRICKY + ["".join(rng.choices(pool, k=rng.randrange(60))) for _ in range(3000)]
    for text in texts:
        ids, decoded = want(library, text)
        found = np.frombuffer(mine.encode(text), dtype="<u4")
        assert found.tolist() == ids, text
        assert mine.decode(found).decode() == decoded, text


def test_report_and_columns(spark, make_docs, library):
    rows = [(i, t) for i, t in enumerate([*TRICKY, None, TRICKY[2]])] + [(None, "x"), (3, TRICKY[3]), (3, TRICKY[3]), (99, "long text " * 20_000)]
    got = sorted(map(tuple, bpe.report(make_docs(rows), PATH).collect()), key=repr)
    expected = []
    for doc_id, text in rows:
        ids, decoded = want(library, text)
        expected.append((doc_id, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                         hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(expected, key=repr)
    docs = make_docs(rows)
    out = bpe.tokenized(docs, PATH)
    assert set(out.columns) == {*docs.columns, "n_tokens", "decoded"}  # "ids" was a column before
    for r in out.collect():
        assert (r.ids, r.decoded) == want(library, r.text)
    assert bpe.report(make_docs([]), PATH).count() == 0
    assert bpe.tokenized(make_docs([]), PATH).count() == 0


def test_whole_small_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in bpe.report(docs, PATH).collect()}
    for r in docs.collect():
        ids, _ = want(library, r.text)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())


def test_caches_forget(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    mine = bpe.Bpe(PATH)
    for text in TRICKY:
        assert np.frombuffer(mine.encode(text), dtype="<u4").tolist() == want(library, text)[0]
