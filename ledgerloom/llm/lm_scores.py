"""Stupid-backoff scores of documents, from n-gram counts of all other documents.

Words and pairs of words are counted over the whole corpus. A pair that occurs in other documents
scores its count over that of its first word; any other pair backs off to ``BACKOFF`` times its
second word's share of all words. A document's own occurrences are taken out of every count, so
that no document is its own evidence. Scores are natural logarithms, summed per document.

The tables are relational but packed. Documents are dealt into buckets of about ``BUCKET_BYTES``;
a bucket's distinct n-grams go out as one row per hash partition (hashes and counts), each partition
adds up its n-grams over all buckets, and its totals come back to the buckets, where they are joined
to the exploded n-grams by rank in hash order. An n-gram is one entry per bucket however frequent it
is, so no partition is hot, and the number of partitions follows the number of n-grams.

Defined results: a null or empty text has no words, sum 0 and no mean; a word that no other
document has counts ``UNSEEN`` times; with no other words in the corpus their number counts as 1;
rows that repeat are documents of their own; a null doc_id stays null; an empty table gives no
rows. N-grams are told apart by their partition and 48 bits of a hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BYTE_VALUE, U64, Stretches, chunks, mix
from .shared import doc_id_of, doc_key

BACKOFF = 0.4
UNSEEN = 0.5
BUCKET_BYTES = 8 << 20
PART_GRAMS = 1 << 20


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column(0)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(chunk.data)]), pa.array([len(chunk.words()[0])])], names=["bytes", "words"]
            )


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each document's begin."""
    found, sizes = [np.empty(0, dtype=U64)], [np.zeros(1, dtype=np.int64)]
    for chunk in chunks(texts):
        starts, ends, bounds = chunk.words()
        found.append(Stretches(BYTE_VALUE[chunk.data])(starts, ends))
        sizes.append(np.diff(bounds))
    return np.concatenate(found), np.cumsum(np.concatenate(sizes))


def _pairs(words: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of neighbouring words of a document, and the number of each pair's first word."""
    inside = np.ones(max(len(words) - 1, 0), dtype=bool)
    borders = begins[1:-1]
    inside[borders[(borders > 0) & (borders < len(words))] - 1] = False
    first = np.flatnonzero(inside)
    return mix(words[first] * U64(0x9E3779B97F4A7C15) + words[first + 1]), first


def _part(grams: np.ndarray, parts: int) -> np.ndarray:
    return (((grams >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)


def _text_column(rows: pa.Table) -> pa.Array:
    return rows["text"].combine_chunks() if rows.num_rows else pa.array([], pa.string())


def _counted(parts: int) -> Callable[[pa.Table], pa.Table]:
    """Of one bucket: a row for each order and partition, hashes ascending."""

    def work(rows: pa.Table) -> pa.Table:
        words, begins = _words(_text_column(rows))
        out: dict[str, list] = {"bucket": [], "size": [], "part": [], "grams": [], "counts": []}
        for size, grams in ((1, words), (2, _pairs(words, begins)[0])):
            some, count = np.unique(grams, return_counts=True)
            part = _part(some, parts)
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))[: len(part)]
            low = some.view(np.uint8).reshape(-1, 8)[:, :6]
            for lo, hi in zip(cuts, np.append(cuts[1:], len(some)), strict=True):
                out["bucket"].append(rows["bucket"][0].as_py())
                out["size"].append(size)
                out["part"].append(int(part[lo]))
                out["grams"].append(low[lo:hi].tobytes())
                out["counts"].append(count[lo:hi].astype("<u4").tobytes())
        return pa.table([
            pa.array(out["bucket"], pa.int32()), pa.array(out["size"], pa.int32()), pa.array(out["part"], pa.int32()),
            pa.array(out["grams"], pa.binary()), pa.array(out["counts"], pa.binary()),
        ], names=list(out))

    return work


def _totalled(rows: pa.Table) -> pa.Table:
    """Of one order and partition: each bucket's n-grams with their counts over all buckets."""
    lows = [np.frombuffer(x.as_py(), dtype=np.uint8).reshape(-1, 6) for x in rows["grams"]]
    bounds = np.append(0, np.cumsum([len(x) for x in lows]))
    wide = np.zeros((int(bounds[-1]), 8), dtype=np.uint8)
    wide[:, :6] = np.concatenate(lows)
    counts = np.concatenate([np.frombuffer(x.as_py(), dtype="<u4") for x in rows["counts"]])
    _, back = np.unique(wide.view(U64).ravel(), return_inverse=True)
    total = np.bincount(back, weights=counts)[back].astype("<u8")  # exact below 2**53
    return pa.table([
        rows["bucket"], rows["size"], rows["part"],
        pa.array([total[lo:hi].tobytes() for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
    ], names=["bucket", "size", "part", "totals"])


def _own(doc: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """How often each n-gram occurs in its own document."""
    order = np.lexsort((gram, doc))
    fresh = np.append(True, (doc[order][1:] != doc[order][:-1]) | (gram[order][1:] != gram[order][:-1]))[: len(order)]
    group = np.cumsum(fresh) - 1
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.bincount(group)[group] if len(order) else 0
    return out


def _scored(all_words: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def work(rows: pa.Table, replies: pa.Table) -> pa.Table:
        words, begins = _words(_text_column(rows))
        pairs, first = _pairs(words, begins)
        doc = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        replies = replies.sort_by([("size", "ascending"), ("part", "ascending")])
        others = []
        for size, grams, place in ((1, words, doc), (2, pairs, doc[first])):
            _, back = np.unique(grams, return_inverse=True)
            own = replies.filter(pa.compute.equal(replies["size"], size))["totals"]
            total = np.frombuffer(b"".join(x.as_py() for x in own), dtype="<u8").astype(np.int64)
            others.append((total[back] if len(back) else np.empty(0, dtype=np.int64)) - _own(place, back))
        n_words = np.diff(begins)
        rest = np.maximum(all_words - n_words, 1)
        alone = np.log(np.maximum(others[0], UNSEEN)) - np.log(rest[doc])
        seen = others[1] > 0
        score = alone.copy()  # a document's first word has no word before it
        score[first + 1] = np.where(
            seen, np.log(np.maximum(others[1], 1)) - np.log(np.maximum(others[0][first], 1)), np.log(BACKOFF) + alone[first + 1]
        )
        total = np.bincount(doc, weights=score, minlength=len(n_words))
        mean = total / np.where(n_words > 0, n_words, 1)
        return pa.table([
            rows["_d"], pa.array(n_words), pa.array(np.bincount(doc[first], weights=seen, minlength=len(n_words)).astype(np.int64)),
            pa.array(total), pa.array(mean, mask=n_words == 0),
        ], names=["_d", "n_words", "n_seen_pairs", "log_score", "mean_log_score"])

    return work


def report(docs: DataFrame) -> DataFrame:
    """One row per document: words, pairs that other documents have, sum and mean of log scores."""
    size, words = docs.select("text").mapInArrow(_sizes, "bytes long, words long").agg(
        F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))
    ).first()
    buckets, parts = max(1, -(-size // BUCKET_BYTES)), max(1, -(-words // PART_GRAMS))
    key = doc_key()
    bucket = F.pmod(F.xxhash64(key, F.xxhash64("text")), F.lit(buckets)).cast("int")
    dealt = docs.select(bucket.alias("bucket"), key.alias("_d"), "text")
    counted = dealt.groupBy("bucket").applyInArrow(
        _counted(parts), "bucket int, size int, part int, grams binary, counts binary"
    )
    replies = counted.groupBy("size", "part").applyInArrow(_totalled, "bucket int, size int, part int, totals binary")
    # the answer's bucket under another name: both sides come from the same rows
    replies = replies.select(F.col("bucket").alias("to"), "size", "part", "totals")
    scored = dealt.groupBy("bucket").cogroup(replies.groupBy("to")).applyInArrow(
        _scored(words), "_d long, n_words long, n_seen_pairs long, log_score double, mean_log_score double"
    )
    return scored.select(
        doc_id_of(F.col("_d")).alias("doc_id"), "n_words", "n_seen_pairs",
        F.round("log_score", 3).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"),
    )


def oracle_sql() -> str:
    """The same scores over the table ``documents``, for DuckDB."""
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), w AS (
  SELECT r, i, ws[i] AS w, ws[i - 1] AS v FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)
), n AS (
  SELECT count(*) AS n FROM w
), c1 AS (
  SELECT w, count(*) AS c FROM w GROUP BY w
), o1 AS (
  SELECT r, w, count(*) AS c FROM w GROUP BY r, w
), c2 AS (
  SELECT v, w, count(*) AS c FROM w WHERE i > 1 GROUP BY v, w
), o2 AS (
  SELECT r, v, w, count(*) AS c FROM w WHERE i > 1 GROUP BY r, v, w
), l AS (
  SELECT r, count(*) AS l FROM w GROUP BY r
), t AS (
  SELECT w.r, w.i, ln(greatest(c1.c - o1.c, {UNSEEN})) - ln(greatest(n.n - l.l, 1)) AS alone,
         c2.c - o2.c AS pair, cv.c - ov.c AS before
  FROM w JOIN c1 ON w.w = c1.w JOIN o1 ON w.r = o1.r AND w.w = o1.w JOIN l ON w.r = l.r CROSS JOIN n
  LEFT JOIN c2 ON w.i > 1 AND w.v = c2.v AND w.w = c2.w
  LEFT JOIN o2 ON w.i > 1 AND w.r = o2.r AND w.v = o2.v AND w.w = o2.w
  LEFT JOIN c1 cv ON w.i > 1 AND w.v = cv.w
  LEFT JOIN o1 ov ON w.i > 1 AND w.r = ov.r AND w.v = ov.w
), s AS (
  SELECT r, count(*) AS n_words, count(*) FILTER (i > 1 AND pair > 0) AS n_seen_pairs,
         sum(CASE WHEN i = 1 THEN alone WHEN pair > 0 THEN ln(pair) - ln(greatest(before, 1))
                  ELSE ln({BACKOFF}) + alone END) AS total
  FROM t GROUP BY r
)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_seen_pairs, 0)::BIGINT AS n_seen_pairs,
       round(coalesce(total, 0.0), 3) AS log_score, round(total / n_words, 6) AS mean_log_score
FROM d LEFT JOIN s USING (r)"""
