"""Word dedup with suffix automata.

Pieces that share a key (see ``windows``) form reference shards of bounded size. A shard's
automaton is built online, in order of place: each piece is streamed through the automaton of all
pieces before it and becomes part of it. After a word is added, the suffix link of the newest
state gives the matching statistic: the longest run of words that ends there and also ended
earlier. Runs of ``WORDS`` words or more mark the window that ends there.

Shards are dealt out by content instead of broadcast whole to every document: a window's key
decides the one shard in which all its occurrences meet, so work and memory follow the repeated
text, not the product of documents and shards.

Defined results: a null or empty text has no words; a text under ``WORDS`` words loses nothing;
rows equal in doc_id and text are one document and get equal results; documents of equal doc_id
and different text are ordered by a hash of the text; a null doc_id comes before all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import chunks
from .shared import doc_id_of
from .windows import Kind, Units, covered, repeated

WORDS = 20


class SuffixAutomaton:
    """Online automaton of all suffixes of what was added so far."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def add(self, word: int) -> int:
        """Append a word; the length of the longest suffix that also ended earlier."""
        follow, link, length = self.next, self.link, self.length
        at, new = self.last, len(follow)
        follow.append({})
        length.append(length[at] + 1)
        link.append(0)
        while at >= 0 and word not in follow[at]:
            follow[at][word] = new
            at = link[at]
        self.last = new
        if at < 0:
            return 0
        known = follow[at][word]
        if length[known] != length[at] + 1:
            # only part of what ends in `known` ends here too: that part gets a state of its own
            part = len(follow)
            follow.append(follow[known].copy())
            length.append(length[at] + 1)
            link.append(link[known])
            link[known] = part
            while at >= 0 and follow[at].get(word) == known:
                follow[at][word] = part
                at = link[at]
            known = part
        link[new] = known
        return length[known]


def repeated_windows(units: Units) -> np.ndarray:
    """Whether the window that begins at a word also begins earlier."""
    number: dict[int, int] = {}
    words = [number.setdefault(v, len(number)) for v in units.values.tolist()]
    automaton = SuffixAutomaton()
    flags = np.zeros(len(words), dtype=bool)
    for piece in range(len(units.bounds) - 1):
        for i in range(units.bounds[piece], units.bounds[piece + 1]):
            if automaton.add(words[i]) >= WORDS:
                flags[i - WORDS + 1] = True
        automaton.add(-1 - piece)  # no match goes over the end of a piece
    return flags


KIND = Kind(size=WORDS, gram=4, longest=32, words=True, first_stays=True, index=repeated_windows, batch_bytes=1 << 18)


def removed_spans(docs: DataFrame) -> DataFrame:
    return repeated(docs, KIND)


def _kept(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    """Words, removed words and the kept words joined by a space, of each document."""
    for chunk in chunks(batch.column(0)):
        starts, ends, bounds = chunk.words()
        gone = covered(batch.column(1).slice(chunk.first, len(chunk)), bounds)
        data = chunk.data.tobytes()
        starts, ends, flags = starts.tolist(), ends.tolist(), gone.tolist()
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            left = b" ".join([data[starts[i]: ends[i]] for i in range(lo, hi) if not flags[i]])
            yield hi - lo, sum(flags[lo:hi]), left


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(n, gone, hashlib.sha256(left).hexdigest()) for n, gone, left in _kept(batch)]
        if rows:
            n, gone, digest = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = [left.decode("utf-8") for _, _, left in _kept(batch)]
        yield pa.RecordBatch.from_arrays([pa.array(rest, pa.string()), batch.column(2)], names=["_text", "_row"])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: words, removed words, digest of the kept ones."""
    found = removed_spans(docs).select(F.col("_row.text"), "spans", doc_id_of(F.col("_d")).alias("doc_id"))
    return found.mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def shortened(docs: DataFrame) -> DataFrame:
    """The documents with only their kept words, joined by spaces, and the columns they came with;
    ``n_chars`` follows the text where it exists."""
    found = removed_spans(docs).select(F.col("_row.text"), "spans", "_row")
    row = found.schema["_row"].dataType
    out = found.mapInArrow(_shortened, T.StructType([T.StructField("_text", T.StringType()), T.StructField("_row", row)]))
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast(row["n_chars"].dataType) if "n_chars" in row.names else None}
    return out.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in row.names])
