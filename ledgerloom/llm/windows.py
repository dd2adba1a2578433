"""Windows of a fixed number of units (bytes or words) that occur more than once in a corpus.

A window's key is the smallest hash of the k-grams in it, so equal windows have equal keys, and
neighbouring windows mostly share theirs. Neighbours of one key form a *piece*: about half a
window's worth of window starts, and the units they cover. Then

1. pieces whose key occurs once, and in which it occurs once, are dropped (semi-join on the key;
   most of a corpus ends here),
2. equal pieces collapse to the first of them: their windows all repeat (aggregated before the
   shuffle, so thousands of copies arrive as one row per task),
3. the different pieces of a key are fetched and indexed together, in batches of bounded size, by
   the operator's own index, which says which windows of a piece occur elsewhere,
4. a key with more than ``MAX_PIECES`` different pieces is dealt out once more by its whole
   windows, each counted by hash: exact, and no task holds the key.

Keys and pieces are told apart by two independent 64-bit hashes together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import BYTE_VALUE, Chunk, Stretches, as_bytes, chunks, column, sliding_min, spread
from .shared import identified, keep, lean

#: Different pieces of one key that an index takes in; see step 4.
MAX_PIECES = 2048
PLACE = ["_d", "_t", "at"]


@dataclass(frozen=True)
class Kind:
    """What a window is made of. ``index`` gets pieces (units of each as bytes, in order of
    place) and returns, per window start in the concatenated units, whether it repeats.
    ``first_stays``: the first occurrence of a window doesn't count as repeated."""

    size: int
    gram: int
    longest: int
    words: bool
    first_stays: bool
    index: Callable[[Units], np.ndarray]
    batch_bytes: int


class Units:
    """Units of the documents or pieces of a chunk: hash values, and where each begins and ends
    in the bytes; ``bounds`` counts units."""

    def __init__(self, chunk: Chunk, words: bool) -> None:
        self.data = chunk.data
        if words:
            self.starts, self.ends, self.bounds = chunk.words()
            self.values = Stretches(BYTE_VALUE[chunk.data])(self.starts, self.ends)
        else:
            self.bounds = chunk.bounds
            self.values = BYTE_VALUE[chunk.data]

    def windows(self, size: int) -> np.ndarray:
        """Whether a window begins at a unit and ends within its document."""
        n = len(self.values) - size + 1
        if n <= 0:
            return np.empty(0, dtype=bool)
        first, after = self.bounds[:-1], self.bounds[1:] - size + 1
        some = after > first
        edges = np.zeros(n + 1, dtype=np.int8)
        edges[first[some]] += 1
        edges[after[some]] -= 1
        return np.cumsum(edges[:n], dtype=np.int8).astype(bool)


def runs(flags: np.ndarray, joined: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true flags; ``joined`` says where a flag goes on from the
    one before it."""
    if not len(flags):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    goes_on = flags[1:] & flags[:-1]
    if joined is not None:
        goes_on &= joined[1:]
    begins, ends = flags.copy(), flags.copy()
    begins[1:] &= ~goes_on
    ends[:-1] &= ~goes_on
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _own_repeats(grams: np.ndarray, key: np.ndarray, flags: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether a piece may repeat a window of its own: its key then occurs at two places in it."""
    wide = len(grams) - len(key)
    around = np.full(len(key) + 2 * wide, np.iinfo(key.dtype).max, dtype=key.dtype)
    around[wide: wide + len(key)] = np.where(flags, ~key, around[0])
    chosen = np.flatnonzero(~sliding_min(around, wide + 1) == grams)  # smallest of some window
    pairs = np.flatnonzero(grams[chosen[1:]] == grams[chosen[:-1]])
    low = np.searchsorted(chosen[pairs], begin)
    return np.searchsorted(chosen[pairs + 1], end + wide) > low


def _scan(kind: Kind) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["key", "piece", *PLACE, "n", "times"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for chunk in chunks(batch.column(2)):
                units = Units(chunk, kind.words)
                flags = units.windows(kind.size)
                if not flags.any():
                    continue
                whole = Stretches(units.values)
                grams = whole.every(kind.gram)
                key = sliding_min(grams, kind.size - kind.gram + 1)
                same = np.ones(len(key), dtype=bool)
                same[1:] = key[1:] == key[:-1]
                begin, end = runs(flags, same)
                parts = -(-(end - begin) // kind.longest)
                begin = kind.longest * spread(np.zeros(len(parts), dtype=np.int64), parts) + np.repeat(begin, parts)
                end = np.minimum(begin + kind.longest, np.repeat(end, parts))
                doc = np.searchsorted(units.bounds, begin, side="right") - 1
                yield pa.RecordBatch.from_arrays([
                    column(key[begin]), column(whole(begin, end + kind.size - 1)),
                    column(d[chunk.first + doc]), column(t[chunk.first + doc]),
                    column(begin - units.bounds[doc]), column((end - begin).astype(np.int32)),
                    column(1 + _own_repeats(grams, key, flags, begin, end).astype(np.int32)),
                ], names=names)

    return scan


def _cut(kind: Kind) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (_d, _t, _row, list of pieces of the document): a row for each piece, with its bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(3)
            for chunk in chunks(batch.column(2).field("text")):
                units = Units(chunk, kind.words)
                lists = wanted.slice(chunk.first, len(chunk))
                doc = np.repeat(np.arange(len(chunk)), lists.value_lengths().to_numpy(zero_copy_only=False))
                rows = lists.flatten()
                at, n = (rows.field(x).to_numpy(zero_copy_only=False) for x in ("at", "n"))
                first = units.bounds[doc] + at
                last = first + n + kind.size - 1
                if kind.words:
                    first, last = units.starts[first], units.ends[last - 1]
                bounds = np.zeros(len(first) + 1, dtype=np.int64)
                np.cumsum(last - first, out=bounds[1:])
                ids = [column(batch.column(i).to_numpy(zero_copy_only=False)[chunk.first + doc]) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([
                    rows.field("key"), *ids, rows.field("at"), rows.field("n"), rows.field("c"),
                    as_bytes(units.data[spread(first, last - first)], bounds),
                ], names=["key", *PLACE, "n", "c", "units"])

    return cut


def _by_key(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Rows sorted by key, in tables of about ``limit`` bytes that hold whole keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) < 4 * limit:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        key = rows["key"].to_numpy()
        begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = pa.compute.binary_length(rows["units"]).to_numpy()
        done, total = 0, np.append(0, np.cumsum(size))
        for at in begins[1:]:
            if total[at] - total[done] >= limit:
                yield rows.slice(done, at - done)
                done = at
        held = rows.slice(done).to_batches()
    if held and sum(len(b) for b in held):
        yield from _halved(pa.Table.from_batches(held).combine_chunks(), limit)


def _halved(rows: pa.Table, limit: int) -> Iterator[pa.Table]:
    key = rows["key"].to_numpy()
    total = np.append(0, np.cumsum(pa.compute.binary_length(rows["units"]).to_numpy()))
    done = 0
    for at in np.flatnonzero(key[1:] != key[:-1]) + 1:
        if total[at] - total[done] >= limit:
            yield rows.slice(done, at - done)
            done = at
    yield rows.slice(done)


def _indexed(kind: Kind) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches, kind.batch_bytes):
            rows = rows.sort_by([(c, "ascending") for c in PLACE]).combine_chunks()
            place = [rows[c].to_numpy() for c in PLACE]
            fresh = np.ones(len(rows), dtype=bool)  # a row of documents that comes twice is one document
            fresh[1:] = np.any([p[1:] != p[:-1] for p in place], axis=0)
            rows = rows.filter(pa.array(fresh)).combine_chunks()
            texts = rows["units"].combine_chunks()
            for chunk in chunks(texts, limit=1 << 62):
                units = Units(chunk, kind.words)
                begin, end = runs(kind.index(units))
                doc = np.searchsorted(units.bounds, begin, side="right") - 1
                yield pa.RecordBatch.from_arrays([
                    rows["_d"].combine_chunks().take(pa.array(doc)), rows["_t"].combine_chunks().take(pa.array(doc)),
                    column(begin - units.bounds[doc] + rows["at"].to_numpy()[doc]), column(end - begin + kind.size - 1),
                ], names=[*PLACE, "len"])

    return indexed


def _windows(kind: Kind) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every window of the pieces by its own hash, with all its places in the batch at hand: a
    window that very many pieces share arrives as one row per batch."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("key", *PLACE, "c")}
            found: dict[str, list[np.ndarray]] = {name: [] for name in ("key", "window", *PLACE, "c")}
            for chunk in chunks(batch.column("units")):
                units = Units(chunk, kind.words)
                begin = np.flatnonzero(units.windows(kind.size))
                doc = np.searchsorted(units.bounds, begin, side="right") - 1
                for name in ("key", "_d", "_t", "c"):
                    found[name].append(col[name][chunk.first + doc])
                found["at"].append(begin - units.bounds[doc] + col["at"][chunk.first + doc])
                found["window"].append(Stretches(units.values)(begin, begin + kind.size))
            rows = {name: np.concatenate(parts) for name, parts in found.items()}
            order = np.lexsort([rows[name] for name in ("at", "_t", "_d", "key", "window")])
            rows = {name: x[order] for name, x in rows.items()}
            same = (rows["window"][1:] == rows["window"][:-1]) & (rows["key"][1:] == rows["key"][:-1])
            again = same & np.all([rows[name][1:] == rows[name][:-1] for name in PLACE], axis=0)
            fresh = np.append(True, ~again)[: len(order)]  # a row of documents that comes twice is one document
            rows = {name: x[fresh] for name, x in rows.items()}
            first = np.flatnonzero(np.append(True, ~same)[: len(order)][fresh])
            bounds = pa.array(np.append(first, len(rows["at"])).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                column(rows["key"][first]), column(rows["window"][first]),
                column(np.add.reduceat(rows["c"], first) if len(first) else rows["c"]),
                *(column(rows[name][first]) for name in PLACE),
                *(pa.ListArray.from_arrays(bounds, column(rows[name])) for name in PLACE),
                column(np.full(len(first), rows["window"][:1].sum())),
            ], names=["key", "window", "c", *PLACE, *(name + "s" for name in PLACE), "batch"])

    return windows


def _joined(kind: Kind) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From places of repeated windows: the stretches that neighbouring windows cover."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, t, at = (batch.column(i).flatten().to_numpy() for i in range(3))
            if kind.first_stays:
                sizes = batch.column(0).value_lengths().to_numpy()
                first = [np.repeat(batch.column(i).to_numpy(), sizes) for i in range(3, 6)]
                later = (d != first[0]) | (t != first[1]) | (at != first[2])
                d, t, at = d[later], t[later], at[later]
            order = np.lexsort((at, t, d))
            d, t, at = d[order], t[order], at[order]
            begin, end = runs(np.ones(len(d), dtype=bool), np.append(
                True, (d[1:] == d[:-1]) & (t[1:] == t[:-1]) & (at[1:] - at[:-1] <= 1))[: len(d)])
            yield pa.RecordBatch.from_arrays(
                [column(d[begin]), column(t[begin]), column(at[begin]), column(at[end - 1] - at[begin] + kind.size)],
                names=[*PLACE, "len"],
            )

    return joined


def _place(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c) for c in PLACE])


def repeated(docs: DataFrame, kind: Kind) -> DataFrame:
    """``_d``, ``_t``, ``_row`` of every document and ``spans``: sorted (at, len) stretches of
    units that repeated windows cover; null where there are none. Stretches may overlap."""
    base = identified(docs)
    rows = base.select("_d", "_t", F.col("_row.text").alias("text")).mapInArrow(
        lean(_scan(kind)), "key long, piece long, _d long, _t long, at long, n int, times int"
    )
    shared_keys = rows.groupBy("key").agg(F.sum("times").alias("c")).where("c > 1").select("key")
    # only keys that occur twice are in the hashed side, once each
    rows = keep(rows.join(shared_keys.hint("shuffle_hash"), "key", "left_semi"))
    heads = rows.groupBy("key", "piece").agg(
        F.count("*").alias("c"), F.max("times").alias("times"), F.min(F.struct(*PLACE, "n")).alias("first")
    )
    copies = rows.join(heads.where("c > 1").select("key", "piece", "first"), ["key", "piece"])
    if kind.first_stays:
        copies = copies.where(_place() != _place("first."))
    found = copies.select(*PLACE, (F.col("n") + (kind.size - 1)).cast("long").alias("len"))

    per_key = heads.groupBy("key").agg(F.count("*").alias("m"), F.sum("times").alias("times")).where("times > 1").drop("times")
    several = keep(heads.join(per_key, "key").select("key", "first.*", "c", (F.col("m") > MAX_PIECES).alias("many")))

    def pieces(many: bool) -> DataFrame:
        wanted = several.where(F.col("many") == many).groupBy("_d", "_t").agg(
            F.collect_list(F.struct("key", "at", "n", "c")).alias("wanted")
        )
        return base.join(wanted, ["_d", "_t"]).mapInArrow(
            lean(_cut(kind)), "key long, _d long, _t long, at long, n int, c long, units binary"
        )

    indexed = pieces(False).repartition("key").sortWithinPartitions("key")
    found = found.union(indexed.mapInArrow(lean(_indexed(kind)), "_d long, _t long, at long, len long"))
    if not several.where("many").isEmpty():
        lists = ", ".join(f"{name}s array<long>" for name in PLACE)
        every = pieces(True).mapInArrow(
            lean(_windows(kind)), f"key long, window long, c long, _d long, _t long, at long, {lists}, batch long"
        )
        counts = every.groupBy("key", "window").agg(F.sum("c").alias("total"), F.min(_place()).alias("first"))
        again = every.drop(*PLACE).join(counts.where("total > 1"), ["key", "window"])
        # rows of a batch hold neighbouring windows of the same pieces
        again = again.select(*[name + "s" for name in PLACE], "first.*", "batch").repartition("batch")
        found = found.union(again.mapInArrow(lean(_joined(kind)), "_d long, _t long, at long, len long"))
    spans = found.groupBy("_d", "_t").agg(F.array_sort(F.collect_list(F.struct("at", "len"))).alias("spans"))
    return base.join(spans, ["_d", "_t"], "left")


def covered(lists: pa.ListArray, bounds: np.ndarray) -> np.ndarray:
    """Flags of the units that the spans of each document cover; ``bounds`` counts units."""
    doc = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    spans = lists.flatten()
    at = spans.field("at").to_numpy(zero_copy_only=False) + bounds[doc]
    edges = np.zeros(int(bounds[-1]) + 1, dtype=np.int32)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + spans.field("len").to_numpy(zero_copy_only=False), -1)
    return np.cumsum(edges[:-1]) > 0
