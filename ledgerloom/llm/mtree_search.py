"""Exact top-k search by inner product with M-trees.

Vectors of length up to R, with the component that brings them to length R added, turn the largest
inner product into the nearest neighbour. Rows are dealt to cells around pivots, and a cell's rows to
shells by their distance to its pivot, about ``TREE_ROWS`` rows each; each shell becomes an M-tree
whose pages are rows of a table. An entry of a page keeps the distance to its page's routing object,
and in inner pages a covering radius; with the triangle inequality these bound the scores below it,
or its own, before any distance is computed. The pivots do the same for whole trees: a shell bounds
the distances in it from both sides.

A query is first searched in one tree, the one nearest to it, for a score to beat; that score is fed
back and decides which other trees can matter at all. Those are searched ``GROUP_TREES`` at a time,
best bound first, for a block of queries, so that a tree prunes what follows and a task sends no
more than k results of a query. Pruning drops what scores strictly below the k-th best so far, so
results are exact, ties included.

A sample of ``SAMPLE`` rows (smallest hash of the id) gives the pivots, and for each query a first
score to beat; both only save work. Of rows with equal vectors only the k + 1 smallest ids can be in
any result, so only those are indexed, and equal query vectors are searched once.

Defined results: rows with a null id take no part, nor vectors that are null or hold null or
non-finite components; rows of equal id are rows of their own, each a candidate for the others, and
each a query with results of its own; vectors match only vectors of their own length; a query with
fewer candidates gets all of them; an empty table gives no rows. Components times the scale must stay
below 2**31 in size.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import keep

SCALE = 64
K = 20
QUERY_STEP = 20
TREE_ROWS = 4096
GROUP_TREES = 8
PAGE_ROWS = 48
QUERY_BLOCK = 1024
SAMPLE = 2048
MAX_CELLS = 256
PAGE_SCHEMA = (
    "tree int, page int, leaf boolean, routes array<long>, radii array<double>, to_parent array<double>, "
    "children array<int>, ids array<long>, rows array<long>, sizes array<int>"
)
HIT_SCHEMA = "qid long, vec_id long, row long, score long"


class Space:
    """Distances among stored vectors, and from queries to them. ``reach`` is R."""

    def __init__(self, dim: int, reach2: int) -> None:
        self.dim, self.reach2 = dim, float(reach2)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.reach2 - (vectors.astype(np.float64) ** 2).sum(axis=1), 0)
        return np.column_stack([vectors, np.sqrt(rest)])

    @staticmethod
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        square = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * (a @ b.T)
        return np.sqrt(np.maximum(square, 0))

    def highest(self, query2: np.ndarray, nearest: np.ndarray) -> np.ndarray:
        """No score is over this for a query of squared length ``query2`` at that distance or
        more; rounding is allowed for."""
        total = query2 + self.reach2
        near = np.maximum(nearest - 1e-7 * np.sqrt(total) - 1e-6, 0)
        return (total - near**2) / 2 + 1e-9 * total + 1e-3


def integers(lists: pa.Array, dim: int) -> np.ndarray:
    """A column of lists of whole numbers as rows of a matrix, filled up with zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), dim), dtype=np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, place] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def build(space: Space, ids: np.ndarray, names: np.ndarray, sizes: np.ndarray, vectors: np.ndarray) -> list[dict]:
    """Pages of the M-tree over these rows; page 0 is the root. ``names`` tell rows of one id apart."""
    lifted, pages, rng = space.lifted(vectors), [], np.random.default_rng(5)

    def page(rows: np.ndarray, router: int | None) -> int:
        number = len(pages)
        made: dict = {"page": number}
        pages.append(made)

        def parents(some: np.ndarray) -> np.ndarray:
            return np.zeros(len(some)) if router is None else space.distances(lifted[some], lifted[[router]])[:, 0]

        if len(rows) <= PAGE_ROWS:
            made |= {"leaf": True, "routes": vectors[rows], "radii": np.empty(0), "to_parent": parents(rows),
                     "children": np.empty(0, dtype=np.int32), "ids": ids[rows], "rows": names[rows], "sizes": sizes[rows]}
            return number
        routers = rng.choice(rows, size=min(PAGE_ROWS, -(-len(rows) // PAGE_ROWS) + 1), replace=False)
        apart = space.distances(lifted[rows], lifted[routers])
        side = apart.argmin(axis=1)
        if len(np.unique(side)) == 1:  # equal vectors: nothing to choose by
            side = np.arange(len(rows)) % len(routers)
        groups = [(r, np.flatnonzero(side == i), i) for i, r in enumerate(routers)]
        groups = [(r, own, i) for r, own, i in groups if len(own)]
        made |= {"leaf": False, "routes": vectors[[r for r, _, _ in groups]],
                 "radii": np.array([apart[own, i].max() for _, own, i in groups]),
                 "to_parent": parents(np.array([r for r, _, _ in groups])),
                 "ids": np.empty(0, dtype=np.int64), "rows": np.empty(0, dtype=np.int64), "sizes": np.empty(0, dtype=np.int32)}
        made["children"] = np.array([page(rows[own], r) for r, own, _ in groups], dtype=np.int32)
        return number

    page(np.arange(len(ids)), None)
    return pages


class Best:
    """The k best of each query so far: highest score, then smallest id. ``floor`` is the score
    that a candidate must reach."""

    def __init__(self, floor: np.ndarray, k: int) -> None:
        self.k, self.floor = k, floor.copy()
        self._top = np.full((len(floor), k), np.iinfo(np.int64).min)
        self._seen: list[tuple[np.ndarray, ...]] = []

    def add(self, queries: np.ndarray, may: np.ndarray, scores: np.ndarray, ids: np.ndarray, names: np.ndarray) -> None:
        """Scores of some entries (columns) for some queries (rows), where ``may`` says so."""
        may = may & (scores >= self.floor[queries][:, None])
        better = np.flatnonzero(may.any(axis=1))
        if not len(better):
            return
        queries, may, scores = queries[better], may[better], scores[better]
        all_ = np.concatenate([self._top[queries], np.where(may, scores, np.iinfo(np.int64).min)], axis=1)
        top = np.partition(all_, all_.shape[1] - self.k, axis=1)[:, -self.k:]
        self._top[queries] = top
        self.floor[queries] = np.maximum(self.floor[queries], top.min(axis=1))
        row, column = np.nonzero(may & (scores >= self.floor[queries][:, None]))
        self._seen.append((queries[row], scores[row, column], ids[column], names[column]))

    def results(self) -> tuple[np.ndarray, ...]:
        """Query, score, id and name of the k best of each query."""
        if not self._seen:
            return (np.empty(0, dtype=np.int64),) * 4
        query, score, ids, names = (np.concatenate(parts) for parts in zip(*self._seen, strict=True))
        good = np.flatnonzero(score >= self.floor[query])
        order = good[np.lexsort((names[good], ids[good], -score[good], query[good]))]
        begins = np.searchsorted(query[order], query[order])
        order = order[np.arange(len(order)) - begins < self.k]
        return query[order], score[order], ids[order], names[order]


def search(space: Space, pages: dict[tuple[int, int], dict], queries: np.ndarray, sizes: np.ndarray, best: Best, roots: dict[int, np.ndarray]) -> None:
    """Best-first over the trees' pages for all queries of a block. ``roots`` has for each tree the
    bound of each query. A query takes part in a page while the page may hold a score that its k
    best don't beat."""
    lifted = np.column_stack([queries, np.zeros(len(queries))]).astype(np.float64)
    query2 = (lifted**2).sum(axis=1)
    exact = query2.max(initial=0) * space.reach2 < 2.0**104
    # per page: bound and distance to the routing object for each query that takes part
    ahead = [(-bound.max(initial=-np.inf), (tree, 0), np.arange(len(queries)), bound, np.zeros(len(queries))) for tree, bound in roots.items()]
    heapq.heapify(ahead)
    while ahead:
        _, number, some, bound, to_router = heapq.heappop(ahead)
        open_ = bound >= best.floor[some]
        some, to_router = some[open_], to_router[open_]
        if not len(some):
            continue
        page = pages[number]
        if number[1] == 0:
            near = np.zeros((len(some), len(page["to_parent"])))
        else:  # by the triangle inequality, before any distance is computed
            near = np.abs(to_router[:, None] - page["to_parent"][None, :])
        if page["leaf"]:
            may = space.highest(query2[some][:, None], near) >= best.floor[some][:, None]
            may &= page["sizes"][None, :] == sizes[some][:, None]
            entries = np.flatnonzero(may.any(axis=0))
            if len(entries):
                # whole numbers far below 2**53: exact as doubles, and much faster to multiply
                score = (lifted[some, :-1] @ page["values"][entries].T).astype(np.int64) if exact else (
                    queries[some] @ page["routes"][entries].T)
                best.add(some, may[:, entries], score, page["ids"][entries], page["rows"][entries])
            continue
        may = space.highest(query2[some][:, None], np.maximum(near - page["radii"], 0)) >= best.floor[some][:, None]
        entries = np.flatnonzero(may.any(axis=0))
        apart = space.distances(lifted[some], page["lifted"][entries])
        bounds = space.highest(query2[some][:, None], np.maximum(apart - page["radii"][entries], 0))
        for j, entry in enumerate(entries):
            who = np.flatnonzero(may[:, entry] & (bounds[:, j] >= best.floor[some]))
            if len(who):
                child = number[0], int(page["children"][entry])
                heapq.heappush(ahead, (-bounds[who, j].max(), child, some[who], bounds[who, j], apart[who, j]))


def _valid(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id and whole-numbered vector of the rows that take part, and how many are equal."""
    def fine(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    found = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", fine))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    found = found.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector"))
    return found.groupBy("vec_id", "vector").agg(F.count("*").alias("copies"))


def _row(copy: Column) -> Column:
    """A name for a row among all of its id."""
    return F.xxhash64("vec_id", "vector", copy.cast("int"))


def _cells(space: Space, pivots: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Nearest pivot of each row, and the distance."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routes = space.lifted(pivots)
        for batch in batches:
            apart = space.distances(space.lifted(integers(batch.column(1), space.dim)), routes)
            cell = apart.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2), pa.array(cell.astype(np.int32)), pa.array(apart[np.arange(len(cell)), cell]),
            ], names=["vec_id", "vector", "row", "cell", "apart"])

    return work


def _planted(space: Space) -> Callable:
    def work(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by([("vec_id", "ascending"), ("row", "ascending")])
        lists = rows["vector"].combine_chunks()
        pages = build(space, rows["vec_id"].to_numpy(), rows["row"].to_numpy(), lists.value_lengths().to_numpy(), integers(lists, space.dim))
        kinds = {"page": pa.int32(), "leaf": pa.bool_(), "radii": pa.list_(pa.float64()), "to_parent": pa.list_(pa.float64()),
                 "children": pa.list_(pa.int32()), "ids": pa.list_(pa.int64()), "rows": pa.list_(pa.int64()), "sizes": pa.list_(pa.int32())}
        out = {name: pa.array([p[name] for p in pages], kind) for name, kind in kinds.items()}
        out["routes"] = pa.array([p["routes"].ravel() for p in pages], pa.list_(pa.int64()))
        out["tree"] = pa.array([key[0].as_py()] * len(pages), pa.int32())
        return pa.table(out)

    return work


@dataclass
class Forest:
    """What is known of all trees, a few numbers each: pivots, and for each tree its cell and the
    least and greatest distance of its rows to the cell's pivot."""

    space: Space
    pivots: np.ndarray
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def bounds(self, queries: np.ndarray, trees: np.ndarray) -> np.ndarray:
        """No score of a query (row) in a tree (column) is over this."""
        lifted = np.column_stack([queries, np.zeros(len(queries))]).astype(np.float64)
        apart = self.space.distances(lifted, self.space.lifted(self.pivots))[:, self.cell[trees]]
        nearest = np.maximum(np.maximum(apart - self.high[trees], self.low[trees] - apart), 0)
        return self.space.highest((lifted**2).sum(axis=1)[:, None], nearest)

    def home(self, queries: np.ndarray) -> np.ndarray:
        """The tree of each query to look into first: of the nearest pivot, its own shell or the nearest."""
        lifted = np.column_stack([queries, np.zeros(len(queries))]).astype(np.float64)
        apart = self.space.distances(lifted, self.space.lifted(self.pivots))
        used = np.unique(self.cell)
        nearest = used[apart[:, used].argmin(axis=1)]
        out = np.empty(len(queries), dtype=np.int64)
        for cell in np.unique(nearest):
            trees, some = np.flatnonzero(self.cell == cell), np.flatnonzero(nearest == cell)
            away = apart[some, cell][:, None]
            out[some] = trees[np.maximum(away - self.high[trees], self.low[trees] - away).argmin(axis=1)]
        return out


def _homes(forest: Forest, sample: np.ndarray, sample_sizes: np.ndarray, k: int) -> Callable:
    """For each query the tree to look into first, and the score to beat in it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = integers(batch.column(1), forest.space.dim)
            size = batch.column(1).value_lengths().to_numpy()
            floors = np.empty(len(vectors), dtype=np.int64)
            for at in range(0, len(vectors), QUERY_BLOCK):
                score = vectors[at: at + QUERY_BLOCK] @ sample.T
                for i, row in enumerate(score):
                    row = np.sort(row[sample_sizes == size[at + i]])
                    floors[at + i] = row[-k] if len(row) >= k else np.iinfo(np.int64).min
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(floors), pa.array(forest.home(vectors).astype(np.int32))],
                names=["qid", "vector", "floor", "home"],
            )

    return work


def _ways(forest: Forest, group_trees: int) -> Callable:
    """For each query the groups of trees that may hold a score as good as the one to beat, but
    for the tree it was searched in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.arange(len(forest.cell))
        for batch in batches:
            floors, homes = (batch.column(i).to_numpy() for i in (2, 3))
            vectors = integers(batch.column(1), forest.space.dim)
            groups: list[np.ndarray] = []
            for at in range(0, len(vectors), QUERY_BLOCK):
                part = slice(at, at + QUERY_BLOCK)
                open_ = forest.bounds(vectors[part], every) >= floors[part][:, None]
                open_[np.arange(len(open_)), homes[part]] = False
                groups += [np.unique(np.flatnonzero(row) // group_trees) for row in open_]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(groups, pa.list_(pa.int32()))], names=["qid", "vector", "floor", "home", "groups"]
            )

    return work


def _found(forest: Forest, k: int, first: bool) -> Callable:
    """Hits of a block of queries in the trees of a group (``first``: in one tree, its home)."""
    space = forest.space

    def work(queries: pa.Table, rows: pa.Table) -> pa.Table:
        queries, pages = queries.combine_chunks(), {}
        for row in rows.to_pylist():
            page = {name: np.asarray(row[name]) for name in ("radii", "to_parent", "children", "ids", "rows", "sizes")}
            page["routes"] = np.asarray(row["routes"], dtype=np.int64).reshape(len(page["to_parent"]), space.dim)
            page["leaf"] = row["leaf"]
            if row["leaf"]:
                page["values"] = page["routes"].astype(np.float64)
            else:
                page["lifted"] = space.lifted(page["routes"])
            pages[row["tree"], row["page"]] = page
        out: dict[str, np.ndarray | list] = {"qid": [], "vec_id": [], "row": [], "score": []}
        if pages and len(queries):
            lists = queries["vector"].combine_chunks()
            vectors = integers(lists, space.dim)
            best = Best(queries["floor"].to_numpy(), k)
            trees = np.unique([tree for tree, _ in pages])
            bounds = forest.bounds(vectors, trees)
            if not first:
                bounds[trees[None, :] == queries["home"].to_numpy()[:, None]] = -np.inf
            search(space, pages, vectors, lists.value_lengths().to_numpy(), best, {int(t): bounds[:, i] for i, t in enumerate(trees)})
            query, score, ids, names = best.results()
            out = {"qid": queries["qid"].to_numpy()[query], "vec_id": ids, "row": names, "score": score}
        return pa.table({name: pa.array(x, pa.int64()) for name, x in out.items()})

    return work


def _shells(bounds: list[np.ndarray], first: np.ndarray) -> Callable:
    """Shell of each row, all cells' shells numbered one after the other."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, apart = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            tree = np.empty(len(cell), dtype=np.int32)
            for c in np.unique(cell):
                own = cell == c
                tree[own] = first[c] + np.searchsorted(bounds[c], apart[own])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1, 2, 4)), pa.array(tree)], names=["vec_id", "vector", "row", "apart", "tree"])

    return work


def _grown(placed: DataFrame, space: Space, pivots: np.ndarray) -> tuple[DataFrame, Forest]:
    """Pages of all trees, and the forest. About ``TREE_ROWS`` rows make a tree; a few numbers for
    each come to the driver."""
    counts = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # MAX_CELLS rows
    wanted = {c: -(-n // TREE_ROWS) for c, n in counts.items()}
    most = max(wanted.values())
    shares = [i / most for i in range(1, most)] or [0.5]
    cuts = placed.groupBy("cell").agg(F.percentile_approx("apart", shares, max(10_000, 20 * most)).alias("cuts")).collect()
    bounds, first, trees = [np.empty(0)] * len(pivots), np.zeros(len(pivots), dtype=np.int64), 0
    for row in sorted(cuts, key=lambda r: r["cell"]):
        c, found = row["cell"], np.array(row["cuts"])
        bounds[c] = np.unique(found[[i * most // wanted[c] - 1 for i in range(1, wanted[c])]])
        first[c] = trees
        trees += len(bounds[c]) + 1
    kinds = "vec_id long, vector array<long>, row long, apart double, tree int"
    dealt = placed.mapInArrow(_shells(bounds, first), kinds)
    known = dealt.groupBy("tree").agg(F.count("*").alias("n"), F.min("apart").alias("low"), F.max("apart").alias("high"))
    known = known.orderBy("tree").toArrow()  # one row for each TREE_ROWS rows
    # a shell that holds far more rows than it should (many at one distance) becomes several trees
    parts = np.maximum(-(-known["n"].to_numpy() // (2 * TREE_ROWS)), 1)
    begin = np.zeros(trees, dtype=np.int64)
    begin[known["tree"].to_numpy()] = np.cumsum(parts) - parts
    split = np.ones(trees, dtype=np.int64)
    split[known["tree"].to_numpy()] = parts
    owner = np.searchsorted(first[np.array(sorted(counts))], known["tree"].to_numpy(), side="right") - 1
    cell = np.array(sorted(counts))[owner]
    forest = Forest(space, pivots, *(np.repeat(x, parts) for x in (cell, known["low"].to_numpy(), known["high"].to_numpy())))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, name = batch.column(4).to_numpy(), batch.column(2).to_numpy()
            new = begin[tree] + name % split[tree]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(new.astype(np.int32))], names=["vec_id", "vector", "row", "tree"])

    rows = dealt.mapInArrow(numbered, "vec_id long, vector array<long>, row long, tree int")
    return keep(rows.groupBy("tree").applyInArrow(_planted(space), PAGE_SCHEMA)), forest


def _asked(queries: DataFrame, pages: DataFrame, blocks: int, work: Callable) -> DataFrame:
    """Blocks of queries (with column ``to``) against the pages (with column ``at``) of that number."""
    block = F.pmod(F.xxhash64("qid"), F.lit(int(blocks))).cast("int")
    queries = queries.withColumn("block", block)
    pairs = queries.select(F.col("to").alias("at"), F.col("block").alias("part")).distinct()
    needed = pages.join(pairs, "at")
    return queries.groupBy("to", "block").cogroup(needed.groupBy("at", "part")).applyInArrow(work, HIT_SCHEMA)


def _best_hits(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id", "row")
    return hits.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k)


def top_k(rows: DataFrame, k: int = K, step: int = QUERY_STEP, scale: int = SCALE) -> DataFrame:
    """For every row whose vec_id is divisible by ``step``: query_id, rank from 1, vec_id and score
    of its ``k`` best among all other rows."""
    whole = keep(_valid(rows, scale))
    # a result holds k rows at most, so of more equal ones the others can't be in it
    copy = F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k + 1)).cast("int")))
    same = Window.partitionBy("vector").orderBy("vec_id", "copy")
    indexed = whole.select("vec_id", "vector", copy.alias("copy")).withColumn("_n", F.row_number().over(same))
    indexed = keep(indexed.where(F.col("_n") <= k + 1).select("vec_id", "vector", _row(F.col("copy")).alias("row")))
    square = F.aggregate("vector", F.lit(0).cast("long"), lambda a, x: a + x * x)
    n, dim, reach2 = indexed.agg(F.count("*"), F.max(F.size("vector")), F.max(square)).first()
    if not n:
        return whole.selectExpr("vec_id AS query_id", "0 AS rank", "vec_id", "vec_id AS score")
    space = Space(dim, reach2)
    some = indexed.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(SAMPLE).toArrow()  # a bounded sample
    lists = some["vector"].combine_chunks()
    sample, sample_sizes = integers(lists, dim), lists.value_lengths().to_numpy()
    pivots = _spread_out(space, sample, min(MAX_CELLS, -(-n // TREE_ROWS)))
    kinds = "vec_id long, vector array<long>, row long, cell int, apart double"
    pages, forest = _grown(keep(indexed.mapInArrow(_cells(space, pivots), kinds)), space, pivots)

    asked = whole.where(F.col("vec_id") % step == 0)
    searched = asked.groupBy("vector").agg(F.min("vec_id").alias("least"))
    searched = searched.select(F.xxhash64("vector", "least").alias("qid"), "vector")
    blocks = -(-n // step // QUERY_BLOCK) + 1
    homes = keep(searched.mapInArrow(_homes(forest, sample, sample_sizes, k + 1), "qid long, vector array<long>, floor long, home int"))
    at_home = _asked(homes.withColumn("to", F.col("home")), pages.withColumn("at", F.col("tree")), blocks, _found(forest, k + 1, True))
    at_home = keep(_best_hits(at_home, k + 1).select("qid", "vec_id", "row", "score"))
    beaten = at_home.groupBy("qid").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k + 1)
    known = homes.join(beaten, "qid", "left").select("qid", "vector", F.greatest("floor", "least").alias("floor"), "home")
    ways = keep(known.mapInArrow(_ways(forest, GROUP_TREES), "qid long, vector array<long>, floor long, home int, groups array<int>"))
    ways = ways.select("qid", "vector", "floor", "home", F.explode("groups").alias("to"))
    grouped = pages.withColumn("at", (F.col("tree") / GROUP_TREES).cast("int"))
    hits = _best_hits(at_home.unionByName(_asked(ways, grouped, blocks, _found(forest, k + 1, False))), k + 1)
    lists_ = hits.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("_n", "vec_id", "score", "row"))).alias("hits"))
    answers = homes.join(lists_, "qid").select("vector", "hits")
    out = asked.withColumnRenamed("vec_id", "query_id").withColumn("own", F.xxhash64("query_id", "vector", F.lit(1))).join(answers, "vector")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    others = F.slice(F.filter("hits", lambda h: h["row"] != F.col("own")), 1, k)
    out = out.select("query_id", F.posexplode(others).alias("_at", "hit"))
    return out.select("query_id", (F.col("_at") + 1).alias("rank"), "hit.vec_id", "hit.score")


def _spread_out(space: Space, sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows of the sample, each the farthest from those before."""
    lifted = space.lifted(sample)
    chosen, near = [0], space.distances(lifted, lifted[[0]])[:, 0]
    while len(chosen) < min(count, len(sample)):
        at = int(near.argmax())
        if near[at] == 0:
            break
        chosen.append(at)
        near = np.minimum(near, space.distances(lifted, lifted[[at]])[:, 0])
    return sample[chosen]


def report(rows: DataFrame) -> DataFrame:
    return top_k(rows)


def oracle_sql() -> str:
    """The same rows over the table ``embeddings``, for DuckDB (sums of whole numbers are exact in doubles)."""
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q, len(embedding) AS size
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.row, a.vec_id AS query_id, c.vec_id, list_dot_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.row <> c.row AND a.size = c.size WHERE a.vec_id % {QUERY_STEP} = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= {K}"""
