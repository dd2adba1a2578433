"""Spelling variants: words one edit apart, found by probing their edits against Bloom filters.

Words are counted over all texts. Of the frequent ones a blocked Bloom filter is built for every
length (all lengths of ``LONGEST`` and more share one): a word's hash chooses one block of 512 bits
and one bit in each of its eight parts. The filters are broadcast, and every word asks them for its
edits: each word with one code point less, and each with one code point replaced by a smaller one.
That finds every pair of near words once, from the longer or the greater of both. Only edits that a
filter knows are shuffled, as two 64-bit hashes, to an exact join with the words; then the two words
themselves are compared, so that neither a filter's nor a hash's error can make a pair.

Filters take about ``BITS`` bits a word. They are cut into parts of ``PART_BLOCKS`` blocks, made by
one task each, and broadcast ``ROUND_PARTS`` parts at a time: where the words need more, they are
probed in several rounds, each for the edits whose blocks it holds. So a broadcast never exceeds
``ROUND_PARTS * PART_BLOCKS * 64`` bytes.

Following forms to the last is pointer doubling: counts grow at least ``RATIO`` times with each
step, so the largest count bounds the number of rounds.

Defined results: a null text has no words, a null doc_id counts as an empty text; repeated rows
count as often as they are there; an empty table, or one without frequent words, gives no rows; of
near words of equal count the smallest in code-point order is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64, mix, powers
from .shared import in_small_batches, keep

MIN_SIZE, MIN_COUNT, RATIO, DAMAGE = 6, 5, 5, 199
BITS = 16
LONGEST = 64
PART_BLOCKS = 1 << 14
ROUND_PARTS = 32
#: Distinct words that a task counts before it sends them on.
COUNTED = 100_000
#: Places of words, one after the other, whose edits are probed at a time.
PROBED = 1 << 16
#: Words that a task probes: it does much work for few bytes, so their size says little about it.
TASK_WORDS = 8_000

RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: All code points that words are made of, ascending.
SIGNS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], dtype=np.uint32)
#: Two random values for each code point up to the last of them.
_VALUES = [mix(np.arange(1, 0x101, dtype=U64) + U64(salt << 32)) for salt in (1, 2)]


def words_of(doc_id: int | None, text: str | None) -> Counter[str]:
    """The words of one document with their counts, of any length."""
    lowered = (text or "").encode().translate(_LOWER).decode()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter[str] = Counter()
    for run, n in Counter(RUN.findall(lowered)).items():
        h = zlib.crc32(run.encode(), start)
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()

    def sent() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
        total.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word, n in words_of(doc_id, text).items():
                if len(word) >= MIN_SIZE:
                    total[word] += n
            if len(total) >= COUNTED:
                yield sent()
    if total:
        yield sent()


class Hashed:
    """Words of one length as a matrix of code points, and both hashes of each and of its edits.

    A hash is the sum of each place's value times a power of an odd number, modulo 2**64."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.size = codes.shape[1]
        self._up, self._down = powers(self.size + 1)
        self._terms = [values[codes] * self._up[: self.size] for values in _VALUES]
        self.sums = [terms.sum(axis=1, dtype=U64) for terms in self._terms]

    def shorter(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Row and hash sums of all words with one code point less; of several equal ones the first."""
        new = np.ones(self.codes.shape, dtype=bool)
        new[:, 1:] = self.codes[:, 1:] != self.codes[:, :-1]
        row, at = np.nonzero(new)
        out = []
        for terms, total in zip(self._terms, self.sums):
            before = np.cumsum(terms, axis=1, dtype=U64)
            after = total[:, None] - before
            out.append(((before - terms) + after * self._down[1])[row, at])
        return row, out

    def replaced(self) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """The same for one code point replaced, one smaller code point after the other."""
        for sign in SIGNS[: np.searchsorted(SIGNS, self.codes.max())]:
            row, at = np.nonzero(self.codes > sign)
            yield row, [
                total[row] + values[sign] * self._up[at] - terms[row, at]
                for values, terms, total in zip(_VALUES, self._terms, self.sums)
            ]


def finished(sums: np.ndarray, size: int) -> np.ndarray:
    return mix(sums + U64(size))


def _by_size(words: pa.Array) -> Iterator[tuple[np.ndarray, Hashed]]:
    """Words of equal length together, as many as ``PROBED`` places hold: their rows and hashes."""
    texts = words.to_pylist()
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        step = max(1, PROBED // int(size))
        for i in range(0, len(rows), step):
            part = rows[i: i + step]
            flat = np.frombuffer("".join(texts[r] for r in part).encode("utf-32-le"), dtype=np.uint32)
            yield part, Hashed(flat.reshape(len(part), int(size)))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = np.empty((2, len(batch)), dtype=U64)
        sizes = np.empty(len(batch), dtype=np.int32)
        for rows, found in _by_size(batch.column(0)):
            sizes[rows] = found.size
            for i in range(2):
                both[i, rows] = finished(found.sums[i], found.size)
        columns = [pa.array(sizes), *[pa.array(x.view(np.int64)) for x in both]]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["word", "n", "size", "h1", "h2"])


def _block(h1: np.ndarray, blocks: int) -> np.ndarray:
    return ((h1 >> U64(32)) * U64(blocks) >> U64(32)).astype(np.int64)


def _bit(h2: np.ndarray, part: int) -> np.ndarray:
    return h2 >> U64(6 * part) & U64(63)


def _filtered(part_blocks: int):
    """The bits of one part of a filter."""

    def work(key: tuple, rows: pa.Table) -> pa.Table:
        size, part, blocks = (k.as_py() for k in key)
        h1, h2 = (rows[name].to_numpy().view(U64) for name in ("h1", "h2"))
        first = part * part_blocks
        bits = np.zeros((min(part_blocks, blocks - first), 8), dtype=U64)
        for i in range(8):
            np.bitwise_or.at(bits, (_block(h1, blocks) - first, i), U64(1) << _bit(h2, i))
        return pa.table({"size": pa.array([size], pa.int32()), "part": pa.array([part], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    return work


def _probe(filters, blocks: dict[int, int], part_blocks: int):
    """Both hashes of every edit that a filter of this round knows, and those of its word."""

    def known(size: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Places of the edits that may be words."""
        parts = filters.value.get(size, {})
        if not parts:
            return np.empty(0, dtype=np.int64)
        block = _block(h1, blocks[size])
        part = block // part_blocks
        found = []
        for number, bits in parts.items():
            at = np.flatnonzero(part == number)
            for i in range(8):
                words = bits[block[at] - number * part_blocks, i]
                at = at[(words >> _bit(h2[at], i) & U64(1)).astype(bool)]
            found.append(at)
        return np.concatenate(found)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [batch.column(i).to_numpy().view(U64) for i in (1, 2)]
            for rows, found in _by_size(batch.column(0)):
                edits = [(found.size - 1, *found.shorter())] if found.size > MIN_SIZE else []
                for size, row, sums in (*edits, *((found.size, *r) for r in found.replaced())):
                    h1, h2 = (finished(s, size) for s in sums)
                    at = known(min(size, LONGEST), h1, h2)
                    if len(at):
                        source = rows[row[at]]
                        columns = [h1[at], h2[at], own[0][source], own[1][source]]
                        yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=["h1", "h2", "s1", "s2"])

    return work


def vocabulary(docs: DataFrame) -> DataFrame:
    """Frequent words: word, n, size in code points, and the hashes h1 and h2."""
    pieces = in_small_batches(docs).select("doc_id", "text").mapInArrow(_counted, "word string, n long")
    frequent = pieces.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)
    return frequent.mapInArrow(_hashed, "word string, n long, size int, h1 long, h2 long")


def near_pairs(words: DataFrame, round_parts: int = ROUND_PARTS, part_blocks: int = PART_BLOCKS, bits: int = BITS) -> DataFrame:
    """All pairs of near words of a kept ``vocabulary``, each once: word_a, n_a, word_b, n_b."""
    spark = words.sparkSession
    shared_size = F.least("size", F.lit(LONGEST))
    # one row for each length up to LONGEST
    counts = words.groupBy(shared_size.alias("size")).agg(F.count("*").alias("n")).collect()
    blocks = {r["size"]: -(-r["n"] * bits // 512) for r in counts}
    of_size = F.get(F.array(*[F.lit(blocks.get(size, 0)) for size in range(LONGEST + 1)]), shared_size).cast("long")
    # the same block as _block: the upper half of the hash, spread evenly over the blocks
    block = F.shiftrightunsigned(F.shiftrightunsigned("h1", 32) * of_size, 32)
    parts = keep(
        words.select(shared_size.alias("size"), F.floor(block / part_blocks).cast("int").alias("part"), of_size.alias("blocks"), "h1", "h2")
        .groupBy("size", "part", "blocks").applyInArrow(_filtered(part_blocks), "size int, part int, bits binary")
    )
    all_parts = [(size, part) for size, n in sorted(blocks.items()) for part in range(-(-n // part_blocks))]
    tasks = max(1, -(-sum(r["n"] for r in counts) // TASK_WORDS))
    dealt = words.select("word", "h1", "h2").repartition(tasks, "h1")
    found = []
    for i in range(0, len(all_parts), round_parts):
        chosen = all_parts[i: i + round_parts]
        low, high = chosen[0], chosen[-1]
        place = F.struct("size", "part")
        bounds = [F.struct(F.lit(size).cast("int").alias("size"), F.lit(part).cast("int").alias("part")) for size, part in (low, high)]
        filters: dict[int, dict[int, np.ndarray]] = {}
        for row in parts.where(place.between(*bounds)).collect():  # round_parts rows of part_blocks * 64 bytes at most
            filters.setdefault(row["size"], {})[row["part"]] = np.frombuffer(row["bits"], dtype=U64).reshape(-1, 8)
        sent = spark.sparkContext.broadcast(filters)
        probed = dealt.mapInArrow(_probe(sent, blocks, part_blocks), "h1 long, h2 long, s1 long, s2 long")
        found.append(keep(probed))
        sent.unpersist()
    if not found:
        return words.selectExpr("word AS word_a", "n AS n_a", "word AS word_b", "n AS n_b").limit(0)
    positives = found[0]
    for more in found[1:]:
        positives = positives.unionByName(more)
    edits = words.select("h1", "h2", F.col("word").alias("word_a"), F.col("n").alias("n_a"))
    sources = words.select(F.col("h1").alias("s1"), F.col("h2").alias("s2"), F.col("word").alias("word_b"), F.col("n").alias("n_b"))
    pairs = positives.join(edits, ["h1", "h2"]).join(sources, ["s1", "s2"])
    return pairs.where(F.levenshtein("word_a", "word_b", 1) == 1).select("word_a", "n_a", "word_b", "n_b")


def variants(docs: DataFrame, round_parts: int = ROUND_PARTS) -> DataFrame:
    """One row per frequent word: word, n, n_near, form, form_n, root."""
    words = keep(vocabulary(docs))
    pairs = near_pairs(words, round_parts)
    both = F.array(
        F.struct(F.col("word_a").alias("word"), F.col("n_b").alias("near_n"), F.col("word_b").alias("near")),
        F.struct(F.col("word_b").alias("word"), F.col("n_a").alias("near_n"), F.col("word_a").alias("near")),
    )
    # a word has few near words, as many as it has edits at most
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = pairs.select(F.inline(both)).groupBy("word").agg(F.count("*").alias("n_near"), best)
    near = near.withColumnRenamed("word", "_word")
    formed = -F.col("best.less") >= RATIO * F.col("n")
    joined = keep(words.join(near, F.col("word") == F.col("_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n"),
    ))
    most = joined.agg(F.max("n")).first()[0] or 1
    steps, reach = 0, MIN_COUNT
    while reach <= most:
        reach *= RATIO
        steps += 1
    hops = joined.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    done = 1
    while done < steps:  # roots lie ``done`` steps ahead, or are the last
        hops = keep(hops)  # read again by what is returned
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("farther"))
        hops = hops.join(ahead, "root", "left").select("word", F.coalesce("farther", "root").alias("root"))
        done *= 2
    out = joined.join(hops.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame) -> DataFrame:
    return variants(docs)


def oracle_sql() -> str:
    """The same rows over the table ``documents``, for DuckDB: the checksum step by step, near words
    by what is left of them without one place, roots by recursion."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE steps AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, range(0, 8)::UBIGINT[]),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{letters.upper()}', '{letters}'), '[a-zÀ-ÿ]+')) AS run FROM documents
), once AS (
  SELECT run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS named FROM runs GROUP BY doc_id, run
), summed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, octet_length(encode(named)) + 1),
      lambda i: ('0x' || substr(hex(encode(named)), (2 * i - 1)::INT, 2))::UBIGINT)),
    lambda c, b: xor(c >> 8, tab[xor(c & 255, b)::INT + 1])), 4294967295::UBIGINT) AS h FROM once, steps
), shortened AS (
  SELECT n, CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
  FROM summed
), vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n FROM shortened WHERE length(word) >= {MIN_SIZE} GROUP BY word HAVING sum(n) >= {MIN_COUNT}
), holes AS (
  SELECT word, n, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN vocabulary b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN vocabulary b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {RATIO} * v.n THEN near END AS form,
    CASE WHEN near_n >= {RATIO} * v.n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS root FROM formed
  UNION SELECT w.word, f.form FROM walk w JOIN formed f ON w.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM formed f JOIN walk w ON f.word = w.word
JOIN formed last ON w.root = last.word AND last.form IS NULL"""
