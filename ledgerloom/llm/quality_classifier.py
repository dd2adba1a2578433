"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or abstain on every document. Expectation-maximisation over
the counts of all vote patterns estimates how often good and bad documents get each vote of each
heuristic, without any gold label; the posterior of a document's pattern is its soft label. A
linear scorer over hashed features of the text learns those labels and scores every document.

Pattern counts cover all documents and number at most 3 ** (number of heuristics), whatever the
input. The scorer is fitted on at most ``SAMPLE`` documents, those with the smallest hash of their
text; that sample only sets its weights.

Defined results: a null or empty text has no words, all measures 0, and is scored like any other;
equal texts get equal scores; where all documents have one pattern its posterior is that of the
starting values; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BYTE_VALUE, SEPARATOR, U64, Chunk, Stretches, chunks
from .quality_rules import STOP_WORDS

SAMPLE = 6000
KEPT_FROM = 0.5
ROUNDS = 50
FALSE_ALARMS = 0.01
FEATURES = 1 << 16
EPOCHS = 30
RATE = 0.5
ABSTAIN, BAD, GOOD = 0, 1, 2


@dataclass(frozen=True)
class Labeller:
    """Votes bad or good where a measure is beyond a bound on that side, else abstains."""

    name: str
    measure: str
    bad: tuple[str, float]
    good: tuple[str, float]

    def votes(self, measures: dict[str, np.ndarray]) -> np.ndarray:
        value = measures[self.measure]
        votes = np.full(len(value), ABSTAIN, dtype=np.int8)
        for vote, (side, bound) in ((GOOD, self.good), (BAD, self.bad)):
            votes[value < bound if side == "under" else value > bound] = vote
        return votes


LABELLERS = (
    Labeller("length", "words", bad=("under", 20), good=("over", 60)),
    Labeller("symbols", "symbols", bad=("over", 0.15), good=("under", 0.02)),
    Labeller("shouting", "capitals", bad=("over", 0.4), good=("under", 0.1)),
    Labeller("stop_words", "stop_words", bad=("under", 0.02), good=("over", 0.08)),
    Labeller("repetition", "same_pair", bad=("over", 0.3), good=("under", 0.1)),
    Labeller("exclamation", "shouts", bad=("over", 0.15), good=("under", 0.02)),
    Labeller("sentences", "stops", bad=("under", 0.01), good=("over", 0.04)),
    Labeller("letters", "letters", bad=("under", 0.8), good=("over", 0.92)),
    Labeller("bare_marks", "bare", bad=("over", 0.25), good=("under", 0.05)),
    Labeller("stutter", "same_word", bad=("over", 0.25), good=("under", 0.05)),
)
_STOP = np.sort(np.concatenate([
    Stretches(BYTE_VALUE[data])(np.array([0]), np.array([len(data)]))
    for data in (np.frombuffer(form.encode(), dtype=np.uint8) for w in STOP_WORDS for form in (w, w.capitalize()))
]))


def _flag(characters: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[ord(c) for c in characters]] = True
    return table


_SYMBOLS, _SHOUTS, _STOPS = _flag("#*$%&|<>"), _flag("!"), _flag(".?")
_WIDE = np.arange(256) > 127
_CAPITALS, _LOWERS = _flag("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flag("abcdefghijklmnopqrstuvwxyz")


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags))
    return total[bounds[1:]] - total[bounds[:-1]]


def _pairs(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether the pair of words that begins at a word also began within the 64 words before."""
    if not len(words):
        return np.empty(0, dtype=bool)
    follower = np.append(words[1:], U64(0))
    pair = words * U64(0x9E3779B97F4A7C15) + follower
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((np.arange(len(words)), pair, doc))
    flags = np.zeros(len(words), dtype=bool)
    a, b = order[:-1], order[1:]
    flags[b] = (pair[a] == pair[b]) & (doc[a] == doc[b]) & (b - a <= 64)
    return flags


def measured(chunk: Chunk) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Measures per document (counts per word, capitals per letter, letters per byte of words), and
    the flags of ``_pairs``."""
    starts, ends, bounds = chunk.words()
    words = Stretches(BYTE_VALUE[chunk.data])(starts, ends)
    n = np.maximum(np.diff(bounds), 1)
    at = np.minimum(np.searchsorted(_STOP, words), len(_STOP) - 1)
    again = _pairs(words, bounds)
    capitals = _sums(_CAPITALS[chunk.data], chunk.bounds)
    letters = capitals + _sums(_LOWERS[chunk.data], chunk.bounds)
    lettered = (_CAPITALS | _LOWERS | _WIDE)[chunk.data]
    visible = np.maximum(_sums(~SEPARATOR[chunk.data], chunk.bounds), 1)
    total = np.append(0, np.cumsum(lettered))
    stutter = np.zeros(len(words), dtype=bool)
    stutter[1:] = words[1:] == words[:-1]
    stutter[bounds[:-1][np.diff(bounds) > 0]] = False
    return {
        "words": np.diff(bounds).astype(float),
        "symbols": _sums(_SYMBOLS[chunk.data], chunk.bounds) / n,
        "shouts": _sums(_SHOUTS[chunk.data], chunk.bounds) / n,
        "stops": _sums(_STOPS[chunk.data], chunk.bounds) / n,
        "capitals": capitals / np.maximum(letters, 1),
        "stop_words": _sums(_STOP[at] == words, bounds) / n,
        "same_pair": _sums(again, bounds) / n,
        "letters": _sums(lettered, chunk.bounds) / visible,
        "bare": _sums(total[ends] == total[starts], bounds) / n,
        "same_word": _sums(stutter, bounds) / n,
    }, again


def patterns(measures: dict[str, np.ndarray], labellers: tuple[Labeller, ...] = LABELLERS) -> np.ndarray:
    """The votes of all labellers as one number with a digit to base 3 for each."""
    number = np.zeros(len(next(iter(measures.values()))), dtype=np.int64)
    for labeller in labellers:
        number = 3 * number + labeller.votes(measures)
    return number


@dataclass
class LabelModel:
    """Share of good documents; chance of each vote of each labeller for bad and good ones."""

    good: float
    votes: np.ndarray  # labeller, class, vote

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        """Chance that a document with these votes is good."""
        chances = np.log([[1 - self.good, self.good]]).repeat(len(pattern), axis=0)
        rest = pattern.copy()
        for table in self.votes[::-1]:
            chances += np.log(table[:, rest % 3]).T
            rest //= 3
        return 1 / (1 + np.exp(np.clip(chances[:, 0] - chances[:, 1], -500, 500)))

    def accuracies(self) -> np.ndarray:
        """Of each labeller where it votes."""
        right = (1 - self.good) * self.votes[:, 0, BAD] + self.good * self.votes[:, 1, GOOD]
        wrong = (1 - self.good) * self.votes[:, 0, GOOD] + self.good * self.votes[:, 1, BAD]
        return right / (right + wrong)


def fit_labels(
    pattern: np.ndarray, count: np.ndarray, labellers: int = len(LABELLERS), precise: bool = True
) -> LabelModel:
    """Expectation-maximisation over counted vote patterns. It starts from heuristics that call a
    third of the bad documents bad, as each looks for one flaw, and one good document in fifty.
    ``precise`` keeps them from calling more good documents bad than ``FALSE_ALARMS``: without
    that, a rarer kind of bad document ends up among the good ones. Every count begins at one, so
    that no chance is 0."""
    model = LabelModel(0.8, np.tile(np.array([[0.1, 0.3, 0.6], [0.08, 0.02, 0.9]]), (labellers, 1, 1)))
    if not len(pattern):
        return model
    digits = np.stack([pattern // 3**k % 3 for k in range(labellers)][::-1])
    for _ in range(ROUNDS):
        good = model.posterior(pattern)
        shares = np.stack([(1 - good) * count, good * count])
        votes = np.ones((labellers, 2, 3))
        for k in range(labellers):
            for side in (0, 1):
                votes[k, side] += np.bincount(digits[k], weights=shares[side], minlength=3)
        good_share = (shares[1].sum() + 1) / (count.sum() + 2)
        votes /= votes.sum(axis=2, keepdims=True)
        if precise:
            over = np.maximum(votes[:, 1, BAD] - FALSE_ALARMS, 0)
            votes[:, 1, BAD] -= over
            votes[:, 1, GOOD] += over
        model = LabelModel(float(good_share), votes)
    return model


def features(chunk: Chunk, again: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the texts, one after the other, and where each document's begin: pairs
    of neighbouring bytes, and for each word whether its pair comes again."""
    data = chunk.data.astype(np.int64)
    pair = data.copy()
    pair[:-1] = data[:-1] * 256 + data[1:]
    pair[chunk.bounds[1:][np.diff(chunk.bounds) > 0] - 1] = 0
    words = chunk.words()[2]
    word = np.where(again, 1, 2)  # bytes 0 1 and 0 2, which no text has
    sizes = np.diff(chunk.bounds) + np.diff(words)
    begins = np.append(0, np.cumsum(sizes))
    out = np.zeros(int(begins[-1]), dtype=np.int64)
    first = np.repeat(begins[:-1] - chunk.bounds[:-1], np.diff(chunk.bounds)) + np.arange(len(data))
    out[first] = pair
    second = np.repeat(begins[:-1] + np.diff(chunk.bounds) - words[:-1], np.diff(words)) + np.arange(len(again))
    out[second] = word
    return out, begins


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, found: np.ndarray, begins: np.ndarray) -> np.ndarray:
        total = np.append(0.0, np.cumsum(self.weights[found]))
        size = np.maximum(np.diff(begins), 1)
        return 1 / (1 + np.exp(-np.clip((total[begins[1:]] - total[begins[:-1]]) / size + self.bias, -30, 30)))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> Scorer:
    """Logistic regression on soft labels by AdaGrad. A row is its features and their shares."""
    scorer = Scorer(np.zeros(FEATURES), 0.0)
    if not len(label):
        return scorer
    size = [len(f) for f, _ in rows]
    found, share = np.concatenate([f for f, _ in rows]), np.concatenate([s for _, s in rows])
    doc = np.repeat(np.arange(len(rows)), size)
    # both classes weigh the same
    weight = label / max(label.sum(), 1e-9) + (1 - label) / max((1 - label).sum(), 1e-9)
    past, past_bias = np.full(FEATURES, 1e-8), 1e-8
    for _ in range(10 * EPOCHS):
        guess = 1 / (1 + np.exp(-np.clip(np.bincount(doc, weights=share * scorer.weights[found], minlength=len(rows)) + scorer.bias, -30, 30)))
        error = (guess - label) * weight
        grad = np.bincount(found, weights=error[doc] * share, minlength=FEATURES)
        past += grad**2
        past_bias += error.sum() ** 2
        scorer.weights -= RATE * 10 * grad / np.sqrt(past)
        scorer.bias -= RATE * error.sum() / np.sqrt(past_bias)
    return scorer


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pattern counts of each batch."""
    for batch in batches:
        for chunk in chunks(batch.column(0)):
            number, count = np.unique(patterns(measured(chunk)[0]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(count)], names=["pattern", "n"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column(0)):
            measures, again = measured(chunk)
            found, begins = features(chunk, again)
            ids, shares = [], []
            for lo, hi in zip(begins[:-1], begins[1:], strict=True):
                some, count = np.unique(found[lo:hi], return_counts=True)
                ids.append(some.astype(np.int32))
                shares.append((count / max(hi - lo, 1)).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(patterns(measures)), pa.array(ids, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))],
                names=["pattern", "ids", "shares"],
            )


def trained(docs: DataFrame, sample: int = SAMPLE) -> tuple[LabelModel, Scorer]:
    texts = docs.select("text")
    counted = texts.mapInArrow(_votes, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toArrow()
    pattern, count = counted["pattern"].to_numpy(), counted["n"].to_numpy()
    order = np.argsort(pattern)
    labels = fit_labels(pattern[order], count[order].astype(float))
    turn = F.xxhash64("text")
    chosen = texts.where("text IS NOT NULL").select(turn.alias("turn")).distinct().orderBy("turn").limit(sample)
    # at most `sample` numbers
    some = texts.join(F.broadcast(chosen), turn == F.col("turn")).dropDuplicates(["turn"])
    rows = some.orderBy("turn").select("text").mapInArrow(_sampled, "pattern long, ids array<int>, shares array<float>").toArrow()
    number = rows["pattern"].to_numpy()
    parts = [(np.asarray(i.values), np.asarray(s.values, dtype=float)) for i, s in zip(rows["ids"], rows["shares"], strict=True)]
    return labels, fit_scorer(parts, labels.posterior(number))


def _scored(labels: LabelModel, scorer: Scorer) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                measures, again = measured(chunk)
                score = scorer.score(*features(chunk, again))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(chunk.first, len(chunk)).cast(pa.int64()), pa.array(score),
                    pa.array(score >= KEPT_FROM), pa.array(labels.posterior(patterns(measures))),
                ], names=["doc_id", "score", "kept", "weak_label"])

    return work


def report(docs: DataFrame) -> DataFrame:
    """One row per document: the scorer's score, whether it is kept, and its soft label."""
    return docs.select("doc_id", "text").mapInArrow(
        _scored(*trained(docs)), "doc_id long, score double, kept boolean, weak_label double"
    )
