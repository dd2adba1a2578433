"""Toxicity by a convolutional text classifier, trained and applied by numpy in Spark's tasks.

Words become two hashed embeddings side by side, so that words that share a row of one table
rarely share both. Filters of several widths run over a document's words, each filter keeps its
largest response, and a logistic layer reads those. What one such model finds depends on the random
numbers it began with, so ``MODELS`` of them learn side by side, and a score is the mean of their
log-odds. Every document is scored over its whole text.

The model is fitted on the whole texts of all labelled rows outside the held-out third (crc32 of the
doc_id as text, modulo 3, is 1). They are dealt out by hash into parts of about ``PART_ROWS`` rows. In
each of ``EPOCHS`` passes every part goes on from the same model; what the parts change is averaged,
a word's rows over those parts that changed them, so the driver sees models only, of a fixed size.
Every fifth labelled row by hash is kept out of the fit; on all of those rows the score is set so that
0.7 is a good threshold, and the thresholds in ``threshold`` are found, per language for languages with
``LANGUAGE_ROWS`` such rows of each label, else over all. They decide ``flagged`` and never touch
``score`` or ``predicted``. Only words enter a score.

Defined results: a null or empty text has the score of a document without words; a null doc_id is
not held out; a document labelled several times counts as toxic if any label says so, null labels
and labels without a document are left out; rows of equal doc_id are texts of that label, those of
equal text too count once; without labels of both kinds every score is the share
of toxic ones (0 without labels); an empty table gives no rows; equal rows give equal rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrays import BYTE_VALUE, LOWER, U64, Chunk, Stretches, chunks
from .shared import broadcast_if_small, forget, keep, lean

#: Labelled rows that one model learns from between averages, and among which it takes random ones.
PART_ROWS = 4000
WINDOW_ROWS = 1000
#: Fixed-point units of what parts add up, so that sums don't depend on their order.
UNIT = 2.0**36
#: One in so many labelled rows is for calibration.
CALIBRATED = 5
LANGUAGE_ROWS = 30
PREDICTED_FROM = 0.7
BITS = 15
DIM = 6
WIDTHS = (1, 2, 3)
FILTERS = 4
MODELS = 2
EPOCHS = 12
BATCH = 32
RATE = 0.1
#: Squared gradients that every word starts with: one document alone hardly moves a word.
STEADY = 1e-3
SPREAD = 0.1
#: Share of words hidden at random in each step, so that no single word is learnt by heart.
WORD_LOSS = 0.5
#: Bytes of words: letters, digits and everything beyond ASCII.
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_GAPS = np.where(LETTER, LOWER, 0x20).astype(np.uint8)
#: The row that stands for no word.
PAD = 1 << BITS


def word_rows(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of both tables for the words of each document, with a pad for the widest filter after
    each, and where each document begins (one entry more for the end)."""
    data = _GAPS[chunk.data]
    starts, ends, bounds = chunk.words(data)
    hashed = Stretches(BYTE_VALUE[data])(starts, ends)
    pad = max(WIDTHS) - 1
    begins = bounds + pad * np.arange(len(bounds))
    place = np.arange(len(starts)) + pad * np.repeat(np.arange(len(chunk)), np.diff(bounds))
    rows = np.full((2, int(begins[-1])), PAD, dtype=np.int32)
    rows[0, place] = (hashed & U64(PAD - 1)).view(np.int64)
    rows[1, place] = (hashed >> U64(64 - BITS)).view(np.int64)
    return rows[0], rows[1], begins


@dataclass
class Cnn:
    """Tables, filters (one matrix; a column for each width, offset and filter) and output."""

    tables: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float

    @classmethod
    def untrained(cls, seed: int = 3) -> Cnn:
        rng = np.random.default_rng(seed)
        tables = rng.normal(0, SPREAD, (2, PAD + 1, DIM)).astype(np.float32)
        tables[:, PAD] = 0
        filters = rng.normal(0, 0.3, (2 * DIM, sum(WIDTHS) * FILTERS)).astype(np.float32)
        count = len(WIDTHS) * FILTERS
        return cls(tables, filters, np.zeros(count, dtype=np.float32), rng.normal(0, 0.3, count).astype(np.float32), 0.0)

    def _responses(self, first: np.ndarray, second: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedded words, and every filter's response at every place. Behind a document's words a
        filter sees nothing, not the document that follows."""
        words = np.concatenate([self.tables[0][first], self.tables[1][second]], axis=1)
        parts = words @ self.filters
        found = np.empty((len(words), len(WIDTHS) * FILTERS), dtype=np.float32)
        column = 0
        for k, width in enumerate(WIDTHS):
            block = found[:, k * FILTERS: (k + 1) * FILTERS]
            block[:] = self.bias[k * FILTERS: (k + 1) * FILTERS]
            for offset in range(width):
                part = parts[:, column: column + FILTERS]
                block[: len(block) - offset] += part[offset:]
                column += FILTERS
        for place in range(1, max(WIDTHS)):
            found[begins[1:] - place] = self.bias
        return words, found

    def pooled(self, first: np.ndarray, second: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each document, 0 at least."""
        if len(begins) < 2:
            return np.empty((0, len(self.out)), dtype=np.float32)
        return np.maximum(np.maximum.reduceat(self._responses(first, second, begins)[1], begins[:-1], axis=0), 0)

    def log_odds(self, pooled: np.ndarray) -> np.ndarray:
        return np.clip(pooled @ self.out + self.out_bias, -30, 30).astype(np.float64)

    def score(self, pooled: np.ndarray) -> np.ndarray:
        return _share(self.log_odds(pooled))

    def step(self, first: np.ndarray, second: np.ndarray, begins: np.ndarray, label: np.ndarray, past: list[np.ndarray]) -> None:
        """One step of AdaGrad on a batch. Only the words under each filter's largest response
        have a gradient."""
        words, found = self._responses(first, second, begins)
        pooled = np.maximum(np.maximum.reduceat(found, begins[:-1], axis=0), 0)
        error = ((self.score(pooled) - label) / len(label)).astype(np.float32)
        to_pooled = np.outer(error, self.out) * (pooled > 0)
        grads = [np.zeros_like(self.filters), to_pooled.sum(axis=0), pooled.T @ error, np.array([error.sum()])]
        # the first place of each filter's largest response in each document
        doc = np.repeat(np.arange(len(label)), np.diff(begins))
        filters, best = np.nonzero((found == pooled[doc]).T)
        _, one = np.unique(filters * len(label) + doc[best], return_index=True)
        filters, best = filters[one], best[one]
        slope = to_pooled[doc[best], filters][:, None]
        places, word_grads, column = [], [], 0
        for k, width in enumerate(WIDTHS):
            mine = filters // FILTERS == k
            for offset in range(width):
                inside = np.flatnonzero(mine & (best + offset < begins[doc[best] + 1]))
                col = column + offset * FILTERS + filters[inside] % FILTERS
                place = best[inside] + offset
                np.add.at(grads[0].T, col, words[place] * slope[inside])
                places.append(place)
                word_grads.append(slope[inside] * self.filters[:, col].T)
            column += width * FILTERS
        places, word_grads = np.concatenate(places), np.concatenate(word_grads)
        some_slope = word_grads.any(axis=1)
        places, word_grads = places[some_slope], word_grads[some_slope]
        for side, ids in enumerate((first, second)):
            some, back = np.unique(ids[places], return_inverse=True)
            grad = np.zeros((len(some), DIM), dtype=np.float32)
            np.add.at(grad, back, word_grads[:, side * DIM: (side + 1) * DIM])
            grad[some == PAD] = 0
            past[0][side, some] += grad**2
            self.tables[side, some] -= RATE * grad / np.sqrt(past[0][side, some] + 1e-8)
        for i, (value, grad) in enumerate(zip((self.filters, self.bias, self.out), grads, strict=False)):
            past[i + 1] += grad**2
            value -= RATE * grad / np.sqrt(past[i + 1] + 1e-8)
        past[4] += grads[3] ** 2
        self.out_bias -= float((RATE * grads[3] / np.sqrt(past[4] + 1e-8))[0])


    def parameters(self) -> list[np.ndarray]:
        """All that is learnt, in the order of ``step``'s squared gradients."""
        return [self.tables, self.filters, self.bias, self.out, np.array([self.out_bias], dtype=np.float32)]


def _flat(arrays: list[np.ndarray]) -> np.ndarray:
    """Parameters as rows of ``DIM`` numbers: those of the tables, then all others."""
    rest = np.concatenate([x.ravel() for x in arrays[1:]])
    return np.concatenate([arrays[0].ravel(), rest, np.zeros(-len(rest) % DIM)]).reshape(-1, DIM).astype(np.float64)


def _unflat(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    ends = np.cumsum([x.size for x in like])
    return [flat.ravel()[end - x.size: end].reshape(x.shape).astype(x.dtype) for x, end in zip(like, ends, strict=True)]


def _model(arrays: list[np.ndarray]) -> Cnn:
    return Cnn(*arrays[:4], float(arrays[4][0]))


def _share(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-log_odds))


@dataclass
class Committee:
    """Models whose mean log-odds, moved by ``shift``, are the score."""

    members: list[Cnn]
    shift: float = 0.0
    thresholds: dict[str | None, float] = field(default_factory=dict)

    def score(self, first: np.ndarray, second: np.ndarray, begins: np.ndarray) -> np.ndarray:
        log_odds = [m.log_odds(m.pooled(first, second, begins)) for m in self.members]
        return _share(np.mean(log_odds, axis=0) + self.shift)


def padded(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``word_rows`` gives, from packed words of each document."""
    pad, size = max(WIDTHS) - 1, np.array([len(x) for x in words], dtype=np.int64)
    begins = np.append(0, np.cumsum(size + pad))
    packed = np.concatenate([*words, np.empty(0, dtype=np.int32)])
    place = np.arange(len(packed)) + pad * np.repeat(np.arange(len(words)), size)
    rows = np.full((2, int(begins[-1])), PAD, dtype=np.int32)
    rows[0, place], rows[1, place] = packed >> BITS, packed & (PAD - 1)
    return rows[0], rows[1], begins


class _Part:
    """Models that go on learning from the rows of one part. ``flat`` and ``past`` hold the
    parameters and squared gradients of one after the other."""

    def __init__(self, flat: np.ndarray, past: np.ndarray, seed: list[int]) -> None:
        like = Cnn.untrained().parameters()
        self.before = flat, past
        self.members = [
            (_model(_unflat(a, like)), _unflat(b, like))
            for a, b in zip(np.split(flat, MODELS), np.split(past, MODELS), strict=True)
        ]
        self.rng, self.held = np.random.default_rng(seed), []

    def add(self, label: int, words: np.ndarray) -> None:
        self.held.append((label, words))
        if len(self.held) == WINDOW_ROWS:
            self.learn()

    def learn(self) -> None:
        order = self.rng.permutation(len(self.held))
        for at in range(0, len(order), BATCH):
            some = [self.held[i] for i in order[at: at + BATCH]]
            first, second, begins = padded([x for _, x in some])
            label = np.array([x for x, _ in some], dtype=np.float32)
            for model, past in self.members:
                lost = self.rng.random(len(first)) < WORD_LOSS
                model.step(np.where(lost, PAD, first), np.where(lost, PAD, second), begins, label, past)
        self.held = []

    def changes(self) -> pa.RecordBatch:
        self.learn()
        now = [np.concatenate([_flat(x) for x in kind]) for kind in ([m.parameters() for m, _ in self.members], [p for _, p in self.members])]
        moved = [x - y for x, y in zip(now, self.before, strict=True)]
        some = np.flatnonzero(moved[0].any(axis=1) | moved[1].any(axis=1))
        units = [np.rint(x[some] * UNIT).astype(np.int64) for x in moved]
        columns = [pa.array(some), *(pa.array(x[:, i].copy()) for x in units for i in range(DIM))]
        return pa.RecordBatch.from_arrays(columns, names=["row", *CHANGES])


#: Columns of a part's changes: of parameters, and of their squared gradients.
CHANGES = [f"{c}{i}" for c in "dp" for i in range(DIM)]


def _learnt(flat: np.ndarray, past: np.ndarray, epoch: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Changes by each part among the task's rows, which come sorted by part and place."""
    flat, past = flat.astype(np.float32), past.astype(np.float32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last, mine = None, None, None
        for batch in batches:
            parts, places, labels = (batch.column(i).to_numpy() for i in range(3))
            lists = batch.column(3)
            values, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
            for i, (part, place) in enumerate(zip(parts.tolist(), places.tolist(), strict=True)):
                if part != at:
                    if mine is not None:
                        yield mine.changes()
                    at, last, mine = part, None, _Part(flat, past, [seed, epoch, part])
                if place != last:  # else an equal row
                    mine.add(int(labels[i]), values[bounds[i]: bounds[i + 1]].copy())
                last = place
        if mine is not None:
            yield mine.changes()

    return work


def fit(rows: DataFrame, seed: int = 3) -> Committee:
    """The models after ``EPOCHS`` passes over all of ``rows`` (part, place, label, words)."""
    begun = [Cnn.untrained(seed + i).parameters() for i in range(MODELS)]
    past = [np.zeros_like(x) for x in begun[0]]
    past[0] += STEADY
    flat, past = np.concatenate([_flat(x) for x in begun]), np.tile(_flat(past), (MODELS, 1))
    rows = rows.select("part", "place", "label", "words")
    schema = ", ".join(["row long", *(f"{c} long" for c in CHANGES)])
    for epoch in range(EPOCHS):
        changes = rows.mapInArrow(lean(_learnt(flat, past, epoch, seed)), schema).groupBy("row")
        # a row for each word row at most, whatever the input
        found = changes.agg(F.count("*").alias("parts"), *(F.sum(c).alias(c) for c in CHANGES)).toArrow()
        moved = np.stack([found[c].to_numpy() for c in CHANGES], axis=1) / (UNIT * found["parts"].to_numpy()[:, None])
        at = found["row"].to_numpy()
        flat[at] += moved[:, :DIM]
        past[at] += moved[:, DIM:]
    return Committee([_model(_unflat(x, begun[0])) for x in np.split(flat, MODELS)])


def thresholds(scores: DataFrame) -> dict[str | None, float]:
    """For all rows (None) and each language with enough: the middle of the gap after the score from
    which on flagging gives the best F1, the highest of several. Equal scores are flagged together.

    Rows are counted down from the highest score, within ranges of log-odds and over these; they only
    cut the work, any give the same."""
    own = scores.where("lang IS NOT NULL").select(F.lit(1).alias("own"), "lang", "label", "score")
    rows = scores.select(F.lit(0).alias("own"), F.lit("").alias("lang"), "label", "score").union(own)
    log_odds = F.log(F.greatest("score", F.lit(1e-13)) / F.greatest(1 - F.col("score"), F.lit(1e-13)))
    rows = rows.groupBy("own", "lang", "score").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
    rows = keep(rows.withColumn("range", F.floor(log_odds * 64)))
    above = Window.partitionBy("own", "lang").orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("own", "lang")
    ranges = rows.groupBy("own", "lang", "range").agg(F.sum("n").alias("rn"), F.sum("hits").alias("rhits"))
    ranges = ranges.select(
        "own", "lang", "range", F.coalesce(F.sum("rn").over(above), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("rhits").over(above), F.lit(0)).alias("hits_above"),
        F.sum("rhits").over(every).alias("toxic"), F.sum("rn").over(every).alias("all"),
    ).where(f"own = 0 OR least(toxic, all - toxic) >= {LANGUAGE_ROWS}")
    down = Window.partitionBy("own", "lang", "range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    counted = rows.join(ranges, ["own", "lang", "range"])
    f1 = 2 * (F.col("hits_above") + F.sum("hits").over(down)) / (F.col("n_above") + F.sum("n").over(down) + F.col("toxic"))
    best = counted.withColumn("f1", f1).groupBy("own", "lang").agg(F.max(F.struct("f1", "score")).alias("best"))
    best = best.select("own", "lang", F.col("best.score").alias("top"))
    below = F.max(F.when(F.col("score") < F.col("top"), F.col("score")))
    found = rows.join(best, ["own", "lang"]).groupBy("own", "lang", "top").agg(F.coalesce(below, F.lit(0.0)).alias("next")).collect()
    forget(rows)
    return {r.lang if r.own else None: (r.top + r.next) / 2 for r in found}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column's texts as words, each the numbers of its two rows in one."""
    pad = max(WIDTHS) - 1
    for batch in batches:
        for chunk in chunks(batch.column(4)):
            first, second, begins = word_rows(chunk)
            words = (first << BITS | second)[first != PAD]
            bounds = pa.array((begins - pad * np.arange(len(begins))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).slice(chunk.first, len(chunk)) for i in range(4)), pa.ListArray.from_arrays(bounds, pa.array(words))],
                names=["label", "lang", "apart", "place", "words"],
            )


def _scored(model: Committee) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
            score = np.empty(batch.num_rows)
            for at in range(0, len(score), BATCH):
                some = range(at, min(at + BATCH, len(score)))
                score[at: at + BATCH] = model.score(*padded([values[bounds[i]: bounds[i + 1]] for i in some]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(score)], names=["place", "lang", "label", "score"])

    return work


def calibrate(model: Committee, rows: DataFrame) -> None:
    """Set the model's thresholds by rows it was not fitted on. Scores move until the best
    threshold over all is ``PREDICTED_FROM``."""
    rows = rows.select("place", "lang", "label", "words")

    def found() -> dict[str | None, float]:
        scores = rows.mapInArrow(lean(_scored(model)), "place long, lang string, label int, score double")
        return thresholds(scores.dropDuplicates(["place", "lang"]))

    model.thresholds = found()
    best = min(max(model.thresholds[None], 1e-6), 1 - 1e-6)
    if best != PREDICTED_FROM:
        model.shift -= float(np.log(best / (1 - best)) - np.log(PREDICTED_FROM / (1 - PREDICTED_FROM)))
        model.thresholds = found()


def trained(docs: DataFrame, labels: DataFrame) -> Committee | float:
    """The model, or the share of toxic labels where there are none of one kind."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = keep(usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label")))
    apart = (F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(CALIBRATED)) == 0).cast("int").alias("apart")
    place = F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("place")
    rows = docs.select("doc_id", "lang", "text").join(broadcast_if_small(usable), "doc_id")
    rows = rows.select("label", "lang", apart, place, "text").mapInArrow(
        lean(_packed), "label int, lang string, apart int, place long, words array<int>"
    )
    parts = max(1, round(usable.count() / PART_ROWS))
    rows = rows.repartition(parts, "place").withColumn("part", F.spark_partition_id())
    rows = keep(rows.sortWithinPartitions("place", "lang"))
    counts = {(r.apart, r.label): r.n for r in rows.groupBy("apart", "label").agg(F.count_distinct("place").alias("n")).collect()}
    toxic, every = sum(n for (_, label), n in counts.items() if label), sum(counts.values())
    if toxic in (0, every):
        return toxic / every if every else 0.0
    two = len(counts) == 4  # else too few rows for two sets
    model = fit(rows.where("apart = 0") if two else rows)
    calibrate(model, rows.where("apart = 1") if two else rows)
    for table in (usable, rows):
        forget(table)
    return model


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: score, prediction at 0.7, and the calibrated verdict."""
    model = trained(docs, labels)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if isinstance(model, Committee):
                parts = [model.score(*word_rows(chunk)) for chunk in chunks(batch.column(3))]
                score = np.concatenate(parts) if parts else np.empty(0)
                every = model.thresholds[None]
                threshold = np.array([model.thresholds.get(x, every) for x in batch.column(2).to_pylist()])
            else:
                score, threshold = np.full(batch.num_rows, model), np.full(batch.num_rows, PREDICTED_FROM)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), batch.column(1), pa.array(score), pa.array((score >= PREDICTED_FROM).astype(np.int32)),
                pa.array(threshold), pa.array(score >= threshold),
            ], names=["doc_id", "held_out", "score", "predicted", "threshold", "flagged"])

    return docs.select("doc_id", held_out(F.col("doc_id")), "lang", "text").mapInArrow(
        work, "doc_id long, held_out boolean, score double, predicted int, threshold double, flagged boolean"
    )
