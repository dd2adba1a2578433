"""N-gram Jaccard join by vertical partitioning.

A document's set holds a hash of each distinct run of a few words (``Measure``). All n-grams have one global
order: very frequent ones last, the others by hash. The order is cut into fragments. Two linked
sets share one of their first n-grams (the share of a set that a partner may lack, and one more),
so those find candidates; the fragments of two candidates are then intersected one by one, each
where the fragment's rows meet, and the partial overlaps are summed per pair.

Equal sets are one class from the start. An n-gram of fewer than ``HOT`` documents brings all its
classes together in pairs. One of more documents finds no candidates for a set with few enough such
n-grams, as any partner shares others too; for the rest it names a leader for each band of sizes,
the class with the fewest n-grams of its own, and the others are compared with that. Classes that
turn out to be connected need no more comparisons among themselves. Of the rest, those that share
frequent n-grams with classes of other components are looked at once more by their whole sets: an
n-gram that only one component has is in common with nobody there, and of the others a set's rarest
bring it together with those that can still have enough in common behind them. So a text changed
too much to link with its group meets nobody, and no link between different components is lost.

How frequent an n-gram is comes from a count of all n-grams of all documents in ``2**BUCKETS``
buckets; its size doesn't depend on the data, and as any order gives right results, a bucket that
several n-grams share does no harm.

Defined results: a null, empty or blank text has an empty set, no links, and is its own component
(each null doc_id too); under that many words the whole sequence is the one n-gram; A-Z count as
a-z; rows of equal doc_id are separate texts of that id; n-grams are told apart by 56 bits of a
hash, sets by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrays import BYTE_VALUE, LOWER, U64, Chunk, Stretches, chunks, mix
from .components import components
from .shared import NO_ID, broadcast_if_small, doc_id_of, identified, keep, lean

BUCKETS = 18
FRAGMENTS = 8
HOT = 8
#: Rows of a frequent n-gram are dealt out over so many keys.
SALTS = 64


@dataclass(frozen=True)
class Measure:
    """Words of an n-gram, and the least similarity of linked sets in percent."""

    gram: int = 4
    percent: int = 85

    def least(self, n: str) -> str:
        """SQL text: the least size of a set that can link with one of size ``n``."""
        return f"(({self.percent} * {n} + 99) div 100)"

    def extra(self, n: str) -> str:
        """SQL text: tokens that find a set's candidates beyond those needed to find any. Any two
        linked sets share more of their first tokens than the smaller of these numbers."""
        return f"({n} * 5 div 100)"

    def first(self, n: str) -> str:
        """SQL text: how many tokens of a set find its candidates."""
        return f"least({n}, {n} - {self.least(n)} + 1 + {self.extra(n)})"

    def overlap(self) -> str:
        """SQL text: the least intersection of linked sets of sizes ``nx`` and ``ny``."""
        return f"({self.percent} * (nx + ny) + {99 + self.percent}) div {100 + self.percent}"

    def first_of(self, n: int) -> int:
        return min(n, n - -(-self.percent * n // 100) + 1 + n * 5 // 100)


#: A token's upper byte is the level of its frequency, the rest its hash.
HASH_BITS = 56


def _grams(chunk: Chunk, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the chunk's documents, and where each document's begin."""
    data = LOWER[chunk.data]
    starts, ends, bounds = chunk.words(data)
    words = Stretches(BYTE_VALUE[data])(starts, ends)
    size = np.diff(bounds)
    count = np.where(size >= gram, size - gram + 1, np.minimum(size, 1))
    begins = np.append(0, np.cumsum(count))
    if not len(words):
        return np.empty(0, dtype=U64), begins
    whole = Stretches(words)
    every = whole.every(gram)
    out = np.empty(int(begins[-1]), dtype=U64)
    inside = np.ones(len(every), dtype=bool)
    # starts too near to the end of their document, and short documents, give no full n-gram
    for near in range(1, gram):
        at = bounds[1:] - near
        at = at[(at >= bounds[:-1]) & (at < len(every))]
        inside[at] = False
    full = np.repeat(size >= gram, count)
    out[full] = every[inside]
    short = np.flatnonzero((size > 0) & (size < gram))
    out[~full] = whole(bounds[short], bounds[short + 1])
    return out, begins


def _counted(gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """N-grams of all documents of the task, by bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKETS, dtype=np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                grams, _ = _grams(chunk, gram)
                total += np.bincount((grams >> U64(64 - BUCKETS)).view(np.int64), minlength=1 << BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return work


def frequency_levels(docs: DataFrame, gram: int) -> np.ndarray:
    """For each bucket 0 for about the mean count or less, else how many times it doubles that."""
    counts = docs.select("text").mapInArrow(lean(_counted(gram)), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = counts.toArrow()  # 2**BUCKETS rows at most, whatever the input
    n = np.zeros(1 << BUCKETS)
    n[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return np.clip(np.log2(np.maximum(n / max(n.mean(), 1.0), 1.0)) - 1, 0, 100).astype(np.uint8)


def _sets(chunk: Chunk, levels: np.ndarray, gram: int) -> Iterator[np.ndarray]:
    """Each document's n-grams as sorted distinct tokens, whose order is the global one."""
    grams, begins = _grams(chunk, gram)
    tokens = (levels[(grams >> U64(64 - BUCKETS)).view(np.int64)].astype(U64) << U64(HASH_BITS)) | (
        mix(grams) >> U64(64 - HASH_BITS))
    tokens = tokens.view(np.int64)
    for lo, hi in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        yield np.unique(tokens[lo:hi])


def _key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _nodes(halves: np.ndarray, bits: int) -> np.ndarray:
    """Short names of classes: ``bits`` of the first half of their keys."""
    return halves[:, 0] >> (64 - bits)


def _classes(levels: np.ndarray, measure: Measure, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Class of each document's set, and its size."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(_key(tokens), len(tokens)) for chunk in chunks(batch.column(2)) for tokens in _sets(chunk, levels, measure.gram)]
            halves = np.frombuffer(b"".join(k for k, _ in sets), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(_nodes(halves, bits)), pa.array(halves[:, 1].copy()),
                pa.array([n for _, n in sets], pa.int64()),
            ], names=["_d", "_t", "node", "more", "n"])

    return work


def _postings(levels: np.ndarray, measure: Measure, bits: int, shared: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first tokens of each document's set, with its class and size."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                firsts, nodes, sizes = [np.empty(0, dtype=np.int64)], [], []
                for tokens in _sets(chunk, levels, measure.gram):
                    firsts.append(tokens[: measure.first_of(len(tokens))])
                    nodes.append(_key(tokens))
                    sizes.append(len(tokens))
                count = [len(x) for x in firsts[1:]]
                tokens = np.concatenate(firsts)
                halves = np.frombuffer(b"".join(nodes), dtype=np.int64).reshape(-1, 2)
                node = _nodes(halves, bits)
                node = np.repeat(np.where(np.isin(node, shared), halves[:, 1], node), count)
                frequent = tokens >> HASH_BITS > 0
                yield pa.RecordBatch.from_arrays([
                    pa.array(tokens), pa.array(np.where(frequent, node % SALTS, 0).astype(np.int32)), pa.array(node),
                    pa.array(np.repeat(sizes, count).astype(np.int32) if len(node) else np.empty(0, dtype=np.int32)),
                ], names=["token", "salt", "node", "n"])

    return work


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From postings sorted by token, salt and class: once each class of a token that several
    classes have, with the number ``c`` of its documents. A frequent token's rows pass as they
    are, with ``HOT`` as number; of others a bucket's count bounds how many there can be."""
    held: list[pa.RecordBatch] = []

    def done(rows: pa.Table, last: bool) -> tuple[pa.RecordBatch | None, list[pa.RecordBatch]]:
        rows = rows.combine_chunks()
        token, salt, node, n = (rows[c].to_numpy() for c in ("token", "salt", "node", "n"))
        if not last:
            end = int(np.searchsorted(token, token[-1]))
            if token[-1] >> HASH_BITS > 0:  # nothing to count: what is here can pass
                end = len(token)
            rest = rows.slice(end).to_batches()
            token, salt, node, n = token[:end], salt[:end], node[:end], n[:end]
        else:
            rest = []
        if not len(token):
            return None, rest
        fresh = np.append(True, (token[1:] != token[:-1]) | (salt[1:] != salt[:-1]))
        group = np.cumsum(fresh) - 1
        begins = np.flatnonzero(fresh)
        count = np.bincount(group)
        several = node[begins] != node[np.append(begins[1:], len(node)) - 1]
        frequent = token[begins] >> HASH_BITS > 0
        first = fresh | np.append(True, node[1:] != node[:-1])
        out = first & (several | frequent)[group]
        c = np.where(frequent, HOT, count)[group][out]
        return pa.RecordBatch.from_arrays(
            [pa.array(token[out]), pa.array(node[out]), pa.array(n[out].astype(np.int64)), pa.array(c)],
            names=["token", "node", "n", "c"],
        ), rest

    for batch in batches:
        held.append(batch)
        if sum(len(b) for b in held) >= 50_000:
            found, held = done(pa.Table.from_batches(held), last=False)
            if found is not None:
                yield found
    if held:
        found, _ = done(pa.Table.from_batches(held), last=True)
        if found is not None:
            yield found


def _lists(parts: list[np.ndarray]) -> pa.Array:
    bounds = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int32)
    values = np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))


def _segments(levels: np.ndarray, measure: Measure) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(node, text) cut into a row for each fragment of the order that has tokens."""
    # frequent tokens share the last fragment
    cuts = (np.arange(1, FRAGMENTS) << HASH_BITS) // (FRAGMENTS - 1) if FRAGMENTS > 1 else np.empty(0, dtype=np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for chunk in chunks(batch.column(1)):
                node, fragment, parts = [], [], []
                for i, tokens in enumerate(_sets(chunk, levels, measure.gram)):
                    if nodes[chunk.first + i] == last:
                        continue  # a row of documents that comes again
                    last = nodes[chunk.first + i]
                    for k, part in enumerate(np.split(tokens, np.searchsorted(tokens, cuts))):
                        if len(part):
                            node.append(last)
                            fragment.append(k)
                            parts.append(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int64()), pa.array(fragment, pa.int32()), _lists(parts)],
                    names=["node", "fragment", "tokens"],
                )

    return work


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of the intersection of each row's two token lists: what both have is there twice
    when the lists of all rows are sorted together."""
    for batch in batches:
        values, rows = [], []
        for i in (2, 3):
            lists = batch.column(i)
            values.append(lists.flatten().to_numpy())
            rows.append(np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()))
        values, rows = np.concatenate(values), np.concatenate(rows)
        order = np.lexsort((values, rows))
        values, rows = values[order], rows[order]
        twice = rows[1:][(values[1:] == values[:-1]) & (rows[1:] == rows[:-1])]
        n = np.bincount(twice, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), pa.array(n)], names=["x", "y", "fragment", "n"])


def _near(measure: Measure) -> Column:
    """Whether sets of sizes nx and ny can link."""
    return F.expr(f"100 * least(nx, ny) >= {measure.percent} * greatest(nx, ny)")


def _thinned(postings: DataFrame, measure: Measure) -> DataFrame:
    """Without sets that share fewer tokens than linked sets do, and without the frequent tokens
    of sets that have no more of them than any partner must share beside them. ``hot`` is a
    set's number of frequent tokens."""
    frequent = F.col("c") >= HOT
    per_node = postings.groupBy("node", "n").agg(F.count("*").alias("shared"), F.count(F.when(frequent, True)).alias("hot"))
    fewest = F.expr(measure.extra(measure.least("n")))
    per_node = per_node.where(F.col("shared") > fewest).select("node", "hot", (F.col("hot") <= fewest).alias("thin"))
    rows = postings.join(per_node, "node").where(~(F.col("thin") & frequent))
    return rows.select("token", "node", "n", "hot", frequent.alias("frequent"))


def _needed(measure: Measure) -> str:
    """SQL text: the number of their first tokens that two linked sets have in common at least."""
    return f"(least({measure.first('nx')} - nx, {measure.first('ny')} - ny) + {measure.overlap()})"


def _enough(measure: Measure) -> Column:
    """Whether two sets met at as many of their first tokens, ``met`` at most, as linked sets do."""
    return F.expr(f"met >= {_needed(measure)}")


def _side(postings: DataFrame, name: str) -> DataFrame:
    return postings.selectExpr("token", f"node AS {name}", f"n AS n{name}", f"hot AS h{name}")


def _candidates(postings: DataFrame, measure: Measure) -> DataFrame:
    """Pairs of classes that share enough tokens to link, as far as counts tell: all that meet at
    a token that isn't frequent, and those of a frequent token's leaders with its other classes.

    A token has a leader for each band of sizes that linked sets may have: the class with the fewest
    tokens that are not frequent. In a group of near copies that is the text they were made from, or
    what is nearest to it, and most of the group links to it."""
    rare, frequent = postings.where("NOT frequent"), postings.where("frequent")
    met = _side(rare, "x").join(_side(rare, "y"), "token").where("x < y").withColumn("met", F.lit(1))
    band = F.expr(f"floor(ln(n) / ln(100D / {measure.percent}))")
    frequent = frequent.withColumn("band", band)
    turn = F.struct((F.expr(measure.first("n")) - F.col("hot")).alias("others"), F.xxhash64("node").alias("turn"), "node", "n", "hot")
    leaders = frequent.groupBy("token", "band").agg(F.min(turn).alias("l"))
    star = frequent.join(leaders, ["token", "band"]).where("node != l.node").selectExpr(
        "token", "least(node, l.node) AS x", "if(node < l.node, n, l.n) AS nx", "if(node < l.node, hot, l.hot) AS hx",
        "greatest(node, l.node) AS y", "if(node < l.node, l.n, n) AS ny", "if(node < l.node, l.hot, hot) AS hy", "0 AS met",
    )
    met = met.unionByName(star.where(_near(measure)))
    met = met.where(_near(measure)).groupBy("x", "y", "nx", "ny", "hx", "hy").agg(F.sum("met").alias("met"))
    # frequent tokens may add to what they met at
    return met.withColumn("met", F.expr("met + least(hx, hy)")).where(_enough(measure)).select("x", "y", "nx", "ny")


def _undecided(postings: DataFrame, labels: DataFrame, measure: Measure) -> DataFrame:
    """Classes, with size and component, that may link with one of another component though they
    meet at frequent tokens only. Linked ones have more of those in common than the smaller of them
    has extra ones, so one at least comes in both sets before the last so many."""
    rows = postings.where("frequent").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    in_order = Window.partitionBy("node").orderBy("token")
    rows = rows.withColumn("rank", F.row_number().over(in_order)).where(f"rank <= hot - {measure.extra(measure.least('n'))}")
    mixed = rows.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    return rows.join(mixed.select("token"), "token", "left_semi").select("node", "n", "component").distinct()


def _left_over(segments: DataFrame, undecided: DataFrame, measure: Measure) -> DataFrame:
    """Pairs of undecided classes of different components that may link, by their whole sets.

    Only tokens that several components have can be in common. In an order of all of these, the
    rarest first, the first that linked sets have in common has as many of its set's, itself
    included, from there on as the two must have in common."""
    tokens = segments.select("node", F.explode("tokens").alias("token")).join(undecided, "node")
    mixed = tokens.groupBy("token").agg(F.count("*").alias("c"), F.min("component").alias("a"), F.max("component").alias("b"))
    rows = tokens.join(mixed.where("a < b").select("token", "c"), "token")
    # a row of segments may come twice, which changes no dense rank
    from_last = Window.partitionBy("node").orderBy(F.desc("c"), F.desc("token"))
    rows = rows.withColumn("left", F.dense_rank().over(from_last)).where(f"left >= {measure.least('n')}")
    x, y = (rows.selectExpr("token", f"node AS {k}", f"n AS n{k}", f"component AS c{k}", f"left AS l{k}") for k in "xy")
    enough = F.expr(f"x < y AND cx != cy AND least(lx, ly) >= {measure.overlap()}")
    return x.join(y, (x.token == y.token) & enough & _near(measure)).select("x", "y", "nx", "ny").distinct()


def _links(pairs: DataFrame, segments: DataFrame, measure: Measure) -> DataFrame:
    """The pairs that link: overlaps counted per fragment, summed per pair."""
    rows = pairs.select("x", "y").join(segments.withColumnsRenamed({"node": "y", "tokens": "b"}), "y")
    rows = rows.join(segments.withColumnsRenamed({"node": "x", "tokens": "a"}), ["x", "fragment"])
    overlap = rows.select("x", "y", "a", "b", "fragment").mapInArrow(_overlaps, "x long, y long, fragment int, n long")
    overlap = overlap.groupBy("x", "y", "fragment").agg(F.max("n").alias("n"))  # once each, if a row came twice
    total = overlap.groupBy("x", "y").agg(F.sum("n").alias("both"))
    linked = F.expr(f"100 * both >= {measure.percent} * (nx + ny - both)")
    return total.join(pairs, ["x", "y"]).where(linked).select("x", "y")


def _whole_sets(nodes: DataFrame, texts: DataFrame, reps: DataFrame, levels: np.ndarray, measure: Measure) -> DataFrame:
    """Segments of the sets of the given classes, from one document of each."""
    chosen = keep(reps.join(nodes, "node").select("node", "rep.*"))
    return keep(texts.join(broadcast_if_small(chosen), ["_d", "_t"]).select("node", "text").mapInArrow(
        lean(_segments(levels, measure)), "node long, fragment int, tokens array<long>"
    ))


def memberships(docs: DataFrame, measure: Measure = Measure(), bits: int = 64) -> DataFrame:
    """``_d``, ``_t`` and set size ``n`` of every document, and ``_component``: the smallest doc_id
    of the documents it is connected with (its own if it has no links).

    Classes go by ``bits`` of their keys while links are looked for. Where two classes have the same,
    both go by the other half of their keys instead."""
    base = identified(docs)
    texts = base.select("_d", "_t", F.col("_row.text").alias("text"))
    levels = frequency_levels(docs, measure.gram)
    rows = keep(texts.mapInArrow(lean(_classes(levels, measure, bits)), "_d long, _t long, node long, more long, n long"))
    several = rows.groupBy("node").agg(F.min("more").alias("a"), F.max("more").alias("b")).where("a != b")
    shared = np.array([r.node for r in several.collect()], dtype=np.int64)  # of 10^10 classes a few
    if len(shared):
        rows = rows.withColumn("node", F.when(F.col("node").isin(shared.tolist()), F.col("more")).otherwise(F.col("node")))
    postings = texts.select("text").mapInArrow(lean(_postings(levels, measure, bits, shared)), "token long, salt int, node long, n int")
    postings = postings.repartition("token", "salt").sortWithinPartitions("token", "salt", "node")
    postings = keep(postings.mapInArrow(lean(_shared), "token long, node long, n long, c long"))
    postings = keep(_thinned(postings, measure))

    reps = rows.where("n > 0").groupBy("node").agg(F.min(F.struct("_d", "_t")).alias("rep"))
    pairs = keep(_candidates(postings, measure))
    paired = pairs.select("x").union(pairs.select("y")).toDF("node").distinct()
    links = keep(_links(pairs, _whole_sets(paired, texts, reps, levels, measure), measure))
    labels = keep(components(links))
    undecided = keep(_undecided(postings, labels, measure))
    if not undecided.isEmpty():
        segments = _whole_sets(undecided.select("node"), texts, reps, levels, measure)
        rest = keep(_left_over(segments, broadcast_if_small(undecided), measure).join(pairs, ["x", "y"], "left_anti"))
        if not rest.isEmpty():
            labels = keep(components(links.union(_links(rest, segments, measure))))
    least = F.min(F.when(F.col("_d") != NO_ID, F.col("_d"))).alias("least")
    classes = rows.where("n > 0").groupBy("node", "more").agg(least)
    # a class without links is a component of its own, told apart by both halves of its key
    classes = classes.join(labels, "node", "left").select(
        "node", "more", "least", F.coalesce("component", "node").alias("component"),
        F.when(F.col("component").isNull(), F.col("more")).alias("alone"),
    )
    smallest = classes.groupBy("component", "alone").agg(F.min("least").alias("low")).alias("s")
    classes = classes.alias("c").join(
        smallest, F.expr("c.component = s.component AND c.alone <=> s.alone")
    ).select("node", "more", F.col("low").alias("least"))
    return _members(rows, classes)


def _members(rows: DataFrame, classes: DataFrame) -> DataFrame:
    rows = rows.join(classes, ["node", "more"], "left")
    own = F.when(F.col("n") > 0, F.col("least"))
    return rows.select("_d", "_t", "n", F.coalesce(own, doc_id_of(F.col("_d"))).alias("_component"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: size of its set, and its component."""
    return memberships(docs).select(
        doc_id_of(F.col("_d")).alias("doc_id"), F.col("n").alias("n_shingles"), F.col("_component").alias("component_id")
    )


def representatives(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """The documents with one of each component, that of the smallest doc_id (among rows of that
    id, the one of the smallest text hash), and all without a set; columns as they came. Rows equal
    in doc_id and text stay as often as they are."""
    places = keep(memberships(docs, measure).select("_d", "_t", "n", "_component").distinct())
    first = places.where("n > 0").groupBy("_component").agg(F.min(F.struct("_d", "_t")).alias("rep")).select("rep.*")
    others = keep(places.where("n > 0").select("_d", "_t").join(first, ["_d", "_t"], "left_anti"))
    return identified(docs).join(broadcast_if_small(others), ["_d", "_t"], "left_anti").select("_row.*")


def oracle_sql() -> str:
    """The same rows over the table ``documents``, for DuckDB: all pairs of different sets that share
    an n-gram, and their components by recursion."""
    letters, gram, percent = "abcdefghijklmnopqrstuvwxyz", Measure().gram, Measure().percent
    return rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{letters.upper()}', '{letters}'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), sets AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(ws) >= {gram}
      THEN list_transform(range(1, len(ws) - {gram - 2}), lambda i: array_to_string(ws[i:i + {gram - 1}], ' '))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS s FROM texts
), classes AS (
  SELECT s, row_number() OVER () AS c, len(s) AS n, min(doc_id) AS low FROM sets WHERE len(s) > 0 GROUP BY s
), grams AS (
  SELECT c, n, unnest(s) AS g FROM classes
), links AS (
  SELECT x, y FROM (SELECT a.c AS x, b.c AS y, a.n AS nx, b.n AS ny, count(*) AS common FROM grams a JOIN grams b ON a.g = b.g AND a.c <> b.c GROUP BY ALL)
  WHERE 100 * common >= {percent} * (nx + ny - common)
), reach AS (
  SELECT c AS a, c AS b FROM classes UNION SELECT reach.a, links.y FROM reach JOIN links ON reach.b = links.x
), lowest AS (
  SELECT a AS c, min(low) AS low FROM reach JOIN classes ON b = c GROUP BY a
)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(lowest.low, doc_id) AS component_id
FROM sets LEFT JOIN classes USING (s) LEFT JOIN lowest USING (c)"""
