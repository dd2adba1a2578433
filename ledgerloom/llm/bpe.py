"""BPE encoding by backtracking, decoding by an offset table.

The tokenizer file gives vocabulary, merges, split pattern and special tokens. A word is encoded
from left to right with the longest token that an Aho-Corasick automaton finds at each place. Two
neighbours are right only if no merge across their border comes before the merges that made them;
this pair table is filled as pairs are met. Where they are not, a shorter prefix token is tried,
and where none is left the last token is taken back; a place found to be a dead end is not tried
again, so the work is linear in the word. The result equals that of applying the merges in order.

Decoding looks up each id's bytes in one flat table by offset.

Defined results: a null text is empty; an empty text has no ids and decodes to an empty text;
special tokens in a text get their own ids, as the tokenizers library does by default.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import spread
from .shared import in_small_batches, lean

#: Stretches, words, and pairs of tokens, whose results a worker remembers at most, within a task.
CACHE_ENTRIES = 250_000


def byte_letters() -> list[str]:
    """The character that stands for each byte in vocabulary files of byte-level tokenizers:
    itself if it is visible, else the next free one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(free)) for b in range(256)]


class _Remembered(dict):
    """Results of a function, forgotten altogether when there are too many."""

    def __init__(self, function) -> None:
        super().__init__()
        self._function = function

    def __missing__(self, key):
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        found = self[key] = self._function(key)
        return found


class Bpe:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocabulary: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._apart = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._pieces = regex.compile(split).findall

        # a symbol is a byte, or 256 + a byte that ends its word
        symbol = {letter: chr(b) for b, letter in enumerate(byte_letters())}

        def symbols(token: str) -> str:
            ends = token.endswith(suffix)
            plain = "".join(symbol[x] for x in (token[: -len(suffix)] if ends else token))
            return plain[:-1] + chr(256 + ord(plain[-1])) if ends else plain

        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self._left, self._right, self._rank = [-1] * size, [-1] * size, [-1] * size
        self._merge: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair, made = (vocabulary[a], vocabulary[b]), vocabulary[a + b]
            self._merge.setdefault(pair, rank)
            if self._rank[made] < 0:
                (self._left[made], self._right[made]), self._rank[made] = pair, rank

        text = {token: symbols(name) for name, token in vocabulary.items()}
        self._length = [len(text.get(t, "")) for t in range(size)]
        # a token that its own text isn't encoded to appears nowhere
        reached = [False] * size
        for token in sorted(text, key=lambda t: self._rank[t]):
            if self._rank[token] < 0:
                reached[token] = self._length[token] == 1
            else:
                a, b = self._left[token], self._right[token]
                reached[token] = reached[a] and reached[b] and not self._crossed(a, b, self._rank[token])
        tokens = {string: token for token, string in text.items() if reached[token]}
        self._automaton = ahocorasick.Automaton()
        self._shorter = [-1] * size  # the longest token that a token begins with
        for string, token in tokens.items():
            self._automaton.add_word(string, token)
            prefixes = (tokens.get(string[:n]) for n in range(len(string) - 1, 0, -1))
            self._shorter[token] = next((t for t in prefixes if t is not None), -1)
        self._automaton.make_automaton()

        self._fits = _Remembered(lambda pair: not self._crossed(*pair, len(self._merge)))
        self._words = _Remembered(self._encode_word)
        self._chunks = _Remembered(self._encode_chunk)

        shown = {token: name for name, token in vocabulary.items()} | {t: name for name, t in self.special.items()}
        raw = [shown.get(t, "").encode() + b" " for t in range(size)]
        self._offsets = np.zeros(size + 1, dtype=np.int64)
        np.cumsum([len(x) for x in raw], out=self._offsets[1:])
        self._bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)

    def _crossed(self, a: int, b: int, before: int) -> bool:
        """Whether a merge over the border of neighbours ``a`` and ``b`` comes earlier than what
        keeps them apart: the merges that made them, undone here from the last one on."""
        merge, rank = self._merge, self._rank
        while True:
            if merge.get((a, b), before) < before:
                return True
            if rank[a] > rank[b]:
                before, a = rank[a], self._right[a]
            elif rank[b] >= 0:
                # among equal merges the one further left, over the border, comes first
                before, b = rank[b] + 1, self._left[b]
            else:
                return False

    def _encode_word(self, word: str) -> bytes:
        data = word.encode().decode("latin-1")
        data = data[:-1] + chr(256 + ord(data[-1]))
        n, length = len(data), self._length
        longest = [-1] * (n + 1)
        for last, token in self._automaton.iter(data):
            first = last + 1 - length[token]
            if longest[first] < 0 or length[token] > length[longest[first]]:
                longest[first] = token
        dead, tokens, at, token = bytearray(n + 1), [], 0, longest[0]
        while at < n:
            end = at + length[token]
            if not dead[end] and (not tokens or self._fits[tokens[-1], token]):
                tokens.append(token)
                at, token = end, longest[end]
            elif self._shorter[token] >= 0:
                token = self._shorter[token]
            else:
                dead[at] = 1
                token = tokens.pop()
                at -= length[token]
        return np.array(tokens, dtype="<u4").tobytes()

    def _encode_chunk(self, chunk: str) -> bytes:
        return b"".join([self._words[x] for x in self._pieces(chunk)])

    def _encode_plain(self, text: str) -> bytes:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # characters are lowered one by one: no final sigma
        return b"".join(map(self._chunks.__getitem__, _gaps(text.replace("Σ", "σ").lower())))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self._apart is None or "<" not in text:
            return self._encode_plain(text)
        return b"".join(
            self.special[part].to_bytes(4, "little") if part in self.special else self._encode_plain(part)
            for part in self._apart.split(text) if part
        )

    def forget(self) -> None:
        """Drop what was remembered: a worker that waits for other work holds no more than tables."""
        for cache in (self._fits, self._words, self._chunks):
            cache.clear()

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts joined by spaces, as UTF-8."""
        starts = self._offsets[ids]
        return self._bytes[spread(starts, self._offsets[ids.astype(np.int64) + 1] - starts)][:-1].tobytes()


#: str.split() also parts at these, which count as symbols in the split pattern.
_NOT_GAPS = regex.compile("[\x1c-\x1f]")
_GAP = regex.compile(r"[^\S\x1c-\x1f]+")


def _gaps(text: str) -> list[str]:
    return _GAP.split(text) if _NOT_GAPS.search(text) else text.split()


@functools.lru_cache(maxsize=4)
def tokenizer(path: str) -> Bpe:
    return Bpe(path)


def _texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of token ids, an array of int."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            found = [bpe.encode(x) for x in _texts(batch.column(0))]
            bounds = np.append(0, np.cumsum([len(x) // 4 for x in found])).astype(np.int32)
            values = pa.Array.from_buffers(pa.int32(), int(bounds[-1]), [None, pa.py_buffer(b"".join(found))])
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(bounds), values), batch.column(1)], names=["ids", "_row"]
            )
        bpe.forget()

    return _beside(docs, text, work, T.ArrayType(T.IntegerType()), ids)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text that their ids decode to."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            found = [bpe.decode(np.array(x or [], dtype=np.uint32)).decode() for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), batch.column(1)], names=["ids", "_row"])

    return _beside(rows, ids, work, T.StringType(), text)


def _beside(rows: DataFrame, source: str, work, kind: T.DataType, name: str) -> DataFrame:
    packed = in_small_batches(rows).select(F.col(f"`{source}`").alias("ids"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"))
    schema = T.StructType([T.StructField("ids", kind), T.StructField("_row", packed.schema["_row"].dataType)])
    out = packed.mapInArrow(lean(work), schema)
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in rows.columns if c != name], F.col("ids").alias(name))


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids``, their number ``n_tokens``, and the text ``decoded`` from them, in one go."""
    made = T.StructType.fromDDL("ids array<int>, n_tokens long, decoded string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        kind = pa.struct([("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("decoded", pa.string())])
        for batch in batches:
            found = [np.frombuffer(bpe.encode(x), dtype="<u4") for x in _texts(batch.column(0))]
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            values = pa.array(np.concatenate(found).view(np.int32) if found else np.empty(0, dtype=np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), values)
            texts = pa.array([bpe.decode(x).decode() for x in found], pa.string())
            made_ = pa.StructArray.from_arrays([lists, pa.array(sizes), texts], fields=list(kind))
            yield pa.RecordBatch.from_arrays([made_, batch.column(1)], names=["ids", "_row"])
        bpe.forget()

    out = _beside(docs, "text", work, made, "_made")
    kept = [c for c in docs.columns if c not in made.names]
    return out.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"_made.{c}").alias(c) for c in made.names])


def report(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: number and digest of its ids, digest of what they decode to."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            ids = [bpe.encode(x) for x in _texts(batch.column(1))]
            texts = [bpe.decode(np.frombuffer(x, dtype="<u4")) for x in ids]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        bpe.forget()

    return in_small_batches(docs).select("doc_id", "text").mapInArrow(
        lean(work), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
