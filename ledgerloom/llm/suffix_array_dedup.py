"""Byte dedup with a run-compressed Burrows-Wheeler transform.

Pieces that share a key (see ``windows``) form the collection of one index, in batches of bounded
size. Of the transform only its runs are kept, with a text position and a match length at the
start of each run (against the suffix before) and at its end (against the suffix after). Inside a
run both lengths fall by one from a text position to the next, so streaming over the text from
sample to sample gives every position its longest match elsewhere; matches of ``LENGTH`` bytes
are marked.

Defined results: a null text is empty; a text under ``LENGTH`` bytes loses nothing; a repeated
row is another document with the same text; documents with equal doc_id and different texts are
different documents; a null doc_id is an id of its own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import Stretches, chunks
from .shared import doc_id_of, lean
from .windows import Kind, Units, covered, repeated, runs

LENGTH = 200


def _suffix_ranks(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rank of every suffix. ``symbols`` are small and 0 where a piece ends (``ends`` gives that
    place for each position); those end marks differ and are ordered by place."""
    n = len(symbols)
    bits = max(int(symbols.max()).bit_length(), 1)
    depth = min(62 // bits, 16)
    padded = np.zeros(n + depth, dtype=np.int64)
    padded[:n] = symbols
    keys = np.zeros(n, dtype=np.int64)
    room = ends - np.arange(n)
    for i in range(depth):
        keys = (keys << bits) | np.where(i < room, padded[i: i + n], 0)
    marks = np.flatnonzero(symbols == 0)

    def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        order = np.argsort(keys)
        fresh = np.ones(n, dtype=bool)
        np.not_equal(keys[order[1:]], keys[order[:-1]], out=fresh[1:])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(fresh) - 1
        return rank, order, bool(fresh.all())

    rank, _, done = ranked(keys)
    rank += len(marks) - 1  # end marks stay below all else, each with a rank of its own
    rank[marks] = np.arange(len(marks))
    wide = int(2 * n).bit_length()
    steps = 62 // wide  # ranks that fit into one key
    place = np.arange(n)
    while not done:
        keys = rank.copy()
        for i in range(1, steps):
            keys = (keys << wide) | rank[np.minimum(place + i * depth, ends)]
        rank, _, done = ranked(keys)
        depth *= steps
    return rank


@dataclass
class RunLengthIndex:
    """Runs of the transform: symbol and length; text position and match length at the first
    (``head_*``) and last (``tail_*``) suffix of each run."""

    symbol: np.ndarray
    length: np.ndarray
    head_at: np.ndarray
    head_match: np.ndarray
    tail_at: np.ndarray
    tail_match: np.ndarray
    n: int

    @classmethod
    def build(cls, values: np.ndarray, bounds: np.ndarray, data: np.ndarray) -> RunLengthIndex:
        """Of the pieces that ``bounds`` marks in ``data``; ``values`` hash its bytes. Positions
        are those of the pieces with one end mark after each."""
        used = np.zeros(256, dtype=np.int64)
        used[data] = 1
        code = np.cumsum(used)
        pieces = len(bounds) - 1
        size = np.diff(bounds)
        n = len(data) + pieces
        piece = np.repeat(np.arange(pieces), size + 1)
        marks = bounds[1:] + np.arange(pieces)
        symbols = np.zeros(n, dtype=np.int64)
        inside = np.ones(n, dtype=bool)
        inside[marks] = False
        symbols[inside] = code[data]
        ends = marks[piece]
        rank = _suffix_ranks(symbols, ends)
        suffix = np.empty(n, dtype=np.int64)
        suffix[rank] = np.arange(n)
        before = symbols[suffix - 1]  # of position 0: the last end mark
        cuts = np.ones(n + 1, dtype=bool)  # no run goes on over an end mark, as these differ
        cuts[1:n] = (before[1:] != before[:-1]) | (before[1:] == 0)
        first = np.flatnonzero(cuts[:n])
        last = np.flatnonzero(cuts[1:])
        padded = np.zeros(n, dtype=np.uint64)
        padded[inside] = values
        match = _matches(Stretches(padded), ends)
        head_match = np.zeros(len(first), dtype=np.int64)
        head_match[1:] = match(suffix[first[1:] - 1], suffix[first[1:]])
        # the last suffix of a run and the first of the next are neighbours
        tail_match = np.append(head_match[1:], 0)
        return cls(before[first], last - first + 1, suffix[first], head_match, suffix[last], tail_match, n)

    def match_ends(self) -> np.ndarray:
        """For each text position, where its longest match elsewhere ends."""
        reach = np.zeros(self.n, dtype=np.int64)
        for at, match in ((self.head_at, self.head_match), (self.tail_at, self.tail_match)):
            side = np.zeros(self.n, dtype=np.int64)
            side[at] = at + match
            np.maximum(reach, np.maximum.accumulate(side), out=reach)
        return reach


def _matches(hashed: Stretches, ends: np.ndarray):
    """Length of the common prefix of two suffixes, by bisection over hashes of stretches."""

    def match(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = np.zeros(len(a), dtype=np.int64)
        room = np.minimum(ends[a] - a, ends[b] - b)
        step = 1 << max(int(room.max(initial=0)).bit_length() - 1, 0)
        while step:
            able = np.flatnonzero(found + step <= room)
            x, y = a[able] + found[able], b[able] + found[able]
            able = able[hashed(x, x + step) == hashed(y, y + step)]
            found[able] += step
            step >>= 1
        return found

    return match


def repeated_windows(units: Units) -> np.ndarray:
    index = RunLengthIndex.build(units.values, units.bounds, units.data)
    pieces = len(units.bounds) - 1
    long = index.match_ends() - np.arange(index.n) >= LENGTH
    marks = units.bounds[1:] + np.arange(pieces)
    return np.delete(long, marks)


BYTES = Kind(size=LENGTH, gram=24, longest=256, words=False, first_stays=False, index=repeated_windows, batch_bytes=1 << 17)


def removed_spans(docs: DataFrame) -> DataFrame:
    return repeated(docs, BYTES)


def _finished(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Bytes, and flags of those to remove, of each document."""
    for chunk in chunks(batch.column(0)):
        gone = covered(batch.column(1).slice(chunk.first, len(chunk)), chunk.bounds)
        for i in range(len(chunk)):
            part = slice(chunk.bounds[i], chunk.bounds[i + 1])
            yield chunk.data[part], gone[part]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (len(data), int(gone.sum()), len(runs(gone)[0]), hashlib.sha256(data[~gone].tobytes()).hexdigest())
            for data, gone in _finished(batch)
        ]
        if rows:
            *counts, digest = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), *(pa.array(x, pa.int64()) for x in counts), pa.array(digest, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = [data[~gone].tobytes().decode("utf-8", "ignore") for data, gone in _finished(batch)]
        yield pa.RecordBatch.from_arrays([pa.array(rest, pa.string()), batch.column(2)], names=["_text", "_row"])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes and runs of them, digest of what is left."""
    found = removed_spans(docs).select(F.col("_row.text"), "spans", doc_id_of(F.col("_d")).alias("doc_id"))
    return found.mapInArrow(
        lean(_digest), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def shortened(docs: DataFrame) -> DataFrame:
    """The documents without their repeated bytes, with the columns they came with. A character
    cut in two loses its other bytes too; ``n_chars`` follows the text where it exists."""
    found = removed_spans(docs).select(F.col("_row.text"), "spans", "_row")
    row = found.schema["_row"].dataType
    out = found.mapInArrow(lean(_shortened), T.StructType([T.StructField("_text", T.StringType()), T.StructField("_row", row)]))
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast(row["n_chars"].dataType) if "n_chars" in row.names else None}
    return out.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in row.names])
