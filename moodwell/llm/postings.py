"""Approximate nearest neighbours in balanced posting lists.

Vectors are clustered on a bounded sample by halving at medians, so that lists are of like
size. A vector goes to the list of its nearest centroid and, near a boundary, to those of others
hardly farther. Centroids are searched in memory, along a graph of their neighbours. A
query visits the lists whose centroids are not much farther than its nearest one, and further
ones until they hold enough vectors; within them, products with all vectors are exact. How much
farther is settled for each table: some queries are compared with all vectors, and the reach
grows until these find enough of their nearest ones, to all lists if need be. For inner products, vectors get one more
component that makes all of them equally long, which turns the largest product into the least
distance.

Lists of numbers that follow each other, which are near each other, make up a shelf. What is moved to be
compared is a vector or a query once for each shelf, with its lists there as bits, not once for each list;
shelves fall into blocks of a set size. Products below a score that a query is known to reach are left out.

Defined results: vectors that are null, zero or hold a null or a number that is not finite take
no part, nor do those of another length than most; copies of a vector are indexed once,
with their least ids, of which no result needs more; repeated ids are listed once and
a query never finds its own id; ties go to the lesser id; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from moodwell.llm.common import written

SAMPLE = 20_000  # vectors that the clusters are fitted on
PER_LIST = 250  # vectors that a list is meant to hold
LISTS = 4096  # at most
REPLICAS = 4  # lists of one vector, at most
NEAR = 1.06  # how much farther a further list of a vector may be
REACH = 1.1  # how much farther a list may be that a query visits, at first
WIDER = (1.1, 1.15, 1.2, 1.25, 1.3, 1.4, 1.6, 2.0, float("inf"))  # then, among all centroids
DEGREE, HOPS = 24, 48  # of the graph of centroids, and steps along it
PROBES = 200  # queries that recall is measured on
FOUND = 0.92  # recall of these at least: some more than 0.9, as they are a sample
BLOCK = 2000  # vectors that the sampled queries are compared with at a time
SHELF = 32  # lists, of numbers that follow each other, that are compared in one go
NUMBERS = 1 << 20  # of the vectors, or queries, that a task holds of a shelf: larger ones fall into blocks
CHUNK = 256  # queries of a block that are compared at a time
LEAST = np.finfo(np.float64).min  # below any score
_RESULT = pa.schema([("asked", pa.string()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def halve(vectors: np.ndarray, size: int) -> np.ndarray:
    """Centroids of groups of at most ``size`` rows, made by halving."""
    out, waiting = [], [np.arange(len(vectors))]
    while waiting:
        rows = waiting.pop()
        part = vectors[rows]
        if len(rows) <= max(size, 1):
            out.append(part.mean(axis=0))
            continue
        # Along the direction in which the rows differ most, found by a few power steps.
        centred = part - part.mean(axis=0)
        way = centred[np.argmax((centred**2).sum(axis=1))]
        for _ in range(8):
            way = centred.T @ (centred @ way)
            length = np.sqrt((way**2).sum())
            if length == 0:
                break
            way = way / length
        order = np.argsort(centred @ way, kind="stable")
        waiting += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return np.array(out, dtype=np.float32)


class CentroidGraph:
    """Centroids and, for each, its nearest ones and a few others."""

    def __init__(self, centroids: np.ndarray, seed: int = 9):
        self.centroids = centroids
        n = len(centroids)
        self.squares = (centroids**2).sum(axis=1)
        near = min(DEGREE, n)
        links = []
        for start in range(0, n, 512):
            far = self.squares - 2 * centroids[start : start + 512] @ centroids.T
            links.append(np.argpartition(far, near - 1, axis=1)[:, :near])
        far_ones = np.random.default_rng(seed).integers(0, n, (n, 4))
        self.links = np.concatenate([np.concatenate(links), far_ones], axis=1)
        self.entries = np.linspace(0, n - 1, min(n, 16)).astype(int)

    def search(self, vectors: np.ndarray, hops: int | None = HOPS) -> np.ndarray:
        """Distances of each vector to the centroids met on the way (None: to all), infinite for others."""
        if hops is None:
            gaps = (vectors**2).sum(axis=1)[:, None] + self.squares - 2 * vectors @ self.centroids.T
            return np.sqrt(np.maximum(gaps, 0))
        rows = np.arange(len(vectors))[:, None]
        own = (vectors**2).sum(axis=1)
        found = np.full((len(vectors), len(self.centroids)), np.inf, dtype=np.float32)
        open_ = np.zeros(found.shape, dtype=bool)

        def meet(ids: np.ndarray) -> None:
            products = np.einsum("bd,bkd->bk", vectors, self.centroids[ids])
            fresh = np.isinf(found[rows, ids])
            gap = np.maximum(own[:, None] + self.squares[ids] - 2 * products, 0)
            open_[rows, ids] |= fresh
            found[rows, ids] = gap

        meet(np.tile(self.entries, (len(vectors), 1)))
        for _ in range(hops):
            waiting = np.where(open_, found, np.inf)
            best = waiting.argmin(axis=1)
            if np.isinf(waiting[rows[:, 0], best]).all():
                break
            open_[rows[:, 0], best] = False
            meet(self.links[best])
        return np.sqrt(found)

    def lists(self, vectors: np.ndarray, ratio: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, list and whether it is the nearest, of lists at most ``ratio`` times as far as that."""
        all_rows, all_lists, all_first = [], [], []
        for start in range(0, len(vectors), 256):
            gaps = self.search(vectors[start : start + 256])
            near = gaps <= gaps.min(axis=1, keepdims=True) * ratio + 1e-6
            places = gaps.argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
            r, c = np.nonzero(near & (places < most))
            all_rows.append(r + start)
            all_lists.append(c)
            all_first.append(places[r, c] == 0)
        return np.concatenate(all_rows), np.concatenate(all_lists), np.concatenate(all_first)

    def visited(
        self, vectors: np.ndarray, reach: float, hops: int | None, held: np.ndarray, want: int
    ) -> np.ndarray:
        """Whether a query visits a list: those within reach, and further ones until ``want`` are held."""
        if np.isinf(reach):
            return np.ones((len(vectors), len(self.centroids)), dtype=bool)
        gaps = self.search(vectors, hops)
        near = gaps <= gaps.min(axis=1, keepdims=True) * reach + 1e-6
        few = np.flatnonzero(near @ held < want)
        if len(few):
            order = self.search(vectors[few], None).argsort(axis=1, kind="stable")
            before = np.cumsum(held[order], axis=1) - held[order]
            r, c = np.nonzero(before < want)
            near[few[r], order[r, c]] = True
        return near


def _widened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """One more component, after which all are as long as the longest."""
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
    return np.concatenate([vectors, rest[:, None]], axis=1).astype(np.float32)


def _by_shelf(rows: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, shelves and the lists of each as bits, one of a row and shelf; and where each pair given is in that."""
    shelves = int(lists.max(initial=0)) // SHELF + 1
    keys, at = np.unique(rows * shelves + lists // SHELF, return_inverse=True)
    bits = np.zeros(len(keys), dtype=np.int64)
    np.bitwise_or.at(bits, at, np.int64(1) << (lists % SHELF))
    return keys // shelves, keys % shelves, bits, at


def assign_lists(df: DataFrame, graph: CentroidGraph, longest: float) -> DataFrame:
    """A row per vector and shelf, with the vector's lists there; ``nearest`` is that of its nearest centroid,
    in the row of its shelf, else -1."""

    def assign(frames):
        for frame in frames:
            vectors = np.array(frame["vector"].tolist(), dtype=np.float64)
            rows, lists, first = graph.lists(_widened(vectors, longest), NEAR, REPLICAS)
            rows, shelves, bits, at = _by_shelf(rows, lists)
            nearest = np.full(len(rows), -1)
            nearest[at[first]] = lists[first]
            yield frame.iloc[rows].assign(shelf=shelves, lists=bits, nearest=nearest)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(assign, f"{fields}, shelf int, lists long, nearest int")


def _as_query(vectors: np.ndarray, graph: CentroidGraph) -> np.ndarray:
    """Queries as long as the centroids: a query's length does not change what it finds."""
    given = np.pad(vectors, ((0, 0), (0, 1))).astype(np.float32)
    scale = float(np.sqrt(graph.squares.max()))
    return given * (scale / np.maximum(np.sqrt((given**2).sum(axis=1, keepdims=True)), 1e-30)).astype(np.float32)


def visit_lists(
    df: DataFrame,
    graph: CentroidGraph,
    reach: float,
    hops: int | None,
    held: np.ndarray,
    want: int,
    known: tuple[np.ndarray, np.ndarray] | None = None,
) -> DataFrame:
    """A row per query: the shelves that it visits and its lists in each, not its vector again for each. Of
    ``known`` vectors, no two of one id, and the lists that they are in, those in lists that it visits give a
    score that ``want`` rows reach at least (null, if too few are met): none below it can be among these."""
    sent = df.sparkSession.sparkContext.broadcast((graph, held, known))

    def visit(frames):
        graph, held, known = sent.value
        for frame in frames:
            vectors = np.array(frame["vector"].tolist(), dtype=np.float64)
            for start in range(0, len(frame), 256):
                part = vectors[start : start + 256]
                visits = graph.visited(_as_query(part, graph), reach, hops, held, want)
                rows, shelves, bits, _ = _by_shelf(*np.nonzero(visits))
                cuts = np.searchsorted(rows, np.arange(1, len(part)))
                yield frame.iloc[start : start + 256].assign(
                    shelf=np.split(shelves, cuts), lists=np.split(bits, cuts), floor=_floors(part, visits, want, known)
                )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(visit, f"{fields}, shelf array<int>, lists array<long>, floor double")


def _floors(
    vectors: np.ndarray, visits: np.ndarray, want: int, known: tuple[np.ndarray, np.ndarray] | None
) -> np.ndarray:
    """The ``want``-th best product of each query with known vectors in lists that it visits."""
    if known is None or len(known[0]) < want:
        return np.full(len(vectors), LEAST)
    scores = vectors @ known[0].T
    scores[~visits[:, known[1]]] = LEAST
    return np.partition(scores, len(known[0]) - want, axis=1)[:, -want]


def choose_reach(
    asking: DataFrame, distinct: DataFrame, index: DataFrame, graph: CentroidGraph, held: np.ndarray, k: int
) -> tuple[float, int | None]:
    """Reach and hops with which a sample of queries finds its nearest vectors. Runs jobs."""
    drawn = asking.orderBy(F.xxhash64("copy"), "copy").limit(PROBES).collect()
    if not drawn:
        return REACH, HOPS
    names, probes = [r["copy"] for r in drawn], np.array([r["vector"] for r in drawn])

    def best_of(frames):
        best, held = np.empty((len(probes), 0)), np.empty((len(probes), 0), dtype=object)
        for frame in frames:
            for start in range(0, len(frame), BLOCK):
                part = frame.iloc[start : start + BLOCK]
                scores = probes @ np.array(part["vector"].tolist(), dtype=np.float64).T
                copies = np.tile(part["copy"].to_numpy(), (len(probes), 1))
                scores[np.array(names)[:, None] == copies] = -np.inf
                best, held = np.concatenate([best, scores], axis=1), np.concatenate([held, copies], axis=1)
                most = np.argpartition(-best, min(k, best.shape[1]) - 1, axis=1)[:, :k]
                best, held = np.take_along_axis(best, most, axis=1), np.take_along_axis(held, most, axis=1)
        at = np.repeat(np.arange(len(probes)), best.shape[1])
        yield pd.DataFrame({"probe": at, "copy": held.ravel(), "score": best.ravel()})

    order = Window.partitionBy("probe").orderBy(F.desc("score"), "copy")
    near = distinct.select("copy", "vector").mapInPandas(best_of, "probe int, copy string, score double")
    near = near.where(F.col("score") > float("-inf")).withColumn("place", F.row_number().over(order))
    # At most PROBES times k rows, each with at most REPLICAS lists.
    wanted = F.broadcast(written(near.where(F.col("place") <= k).select("probe", "copy"), "nearest"))
    met = index.select("copy", "shelf", "lists").join(wanted, "copy").groupBy("probe", "copy")
    # A vector has one row of a shelf, and no list of it is in another.
    rows = met.agg(F.collect_list(F.struct("shelf", "lists")).alias("held")).collect()
    found = [[s.shelf * SHELF + i for s in r.held for i in range(SHELF) if s.lists >> i & 1] for r in rows]
    given = _as_query(probes, graph)
    for reach, hops in [(REACH, HOPS), *((wide, None) for wide in WIDER)]:
        visits = graph.visited(given, reach, hops, held, k + 1)
        if sum(bool(visits[r["probe"], lists].any()) for r, lists in zip(rows, found)) >= FOUND * len(rows):
            break
    return reach, hops


def _blocks(df: DataFrame, most: int, name: str) -> DataFrame:
    """How many blocks of about ``most`` rows each shelf has."""
    return df.groupBy("shelf").agg(F.ceil(F.count("*") / most).cast("int").alias(name))


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, a row each, without objects for each."""
    return np.concatenate([c.flatten() for c in column.chunks]).astype(np.float64).reshape(len(column), -1)


def compare(there: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    """The ``k`` best rows of a block of a shelf for each query of a block, by exact products with all vectors
    in lists that the query visits."""
    out: list[pa.Table] = [_RESULT.empty_table()]
    if not len(there) or not len(asked):
        return out[0]
    x, q = _vectors(there["vector"]), _vectors(asked["vector"])
    x_lists, q_lists = there["lists"].to_numpy(), asked["lists"].to_numpy()
    ids, sizes = there["ids"].combine_chunks().flatten().to_numpy(), there["ids"].combine_chunks().value_lengths().to_numpy()
    starts = np.cumsum(sizes) - sizes
    # So many vectors have k ids among them, also where one id has several.
    want = min(len(x), k * int(np.unique(ids, return_counts=True)[1].max()))
    floors = asked["floor"].to_numpy()
    longest = np.sqrt((x**2).sum(axis=1).max())
    for start in range(0, len(q), CHUNK):
        part, floor = q[start : start + CHUNK], floors[start : start + CHUNK]
        products = part @ x.T
        apart = (q_lists[start : start + CHUNK, None] & x_lists) == 0
        if apart.any():
            products[apart] = -np.inf
        slack = np.nan_to_num(1e-12 * longest * np.sqrt((part**2).sum(axis=1)), posinf=0)
        least = np.maximum(floor - slack, LEAST)
        near = products >= least[:, None]
        many = np.flatnonzero(near.sum(axis=1) > want)
        if len(many):
            last = np.partition(products[many], len(x) - want, axis=1)[:, len(x) - want]
            near[many] = products[many] >= np.maximum(last - slack[many], least[many])[:, None]
        row, at = np.nonzero(near)
        # Summed in one order wherever the vector stands.
        scores = [(x[at[s : s + BLOCK]] * part[row[s : s + BLOCK]]).sum(axis=1) for s in range(0, len(row), BLOCK)]
        score = np.concatenate([np.empty(0), *scores])
        # The best vectors of a query, and of these the best rows.
        order = np.lexsort((ids[starts[at]], -score, row))
        order = order[_place(row[order]) < want]
        row, at, score = row[order], at[order], score[order]
        n = sizes[at]
        row, score = np.repeat(row, n), np.repeat(score, n)
        found = ids[np.repeat(starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        order = np.lexsort((-score, found, row))
        row, found, score = row[order], found[order], score[order]
        once = np.r_[True, (row[1:] != row[:-1]) | (found[1:] != found[:-1])][: len(row)]
        row, found, score = row[once], found[once], score[once]
        order = np.lexsort((found, -score, row))
        order = order[_place(row[order]) < k]
        names = asked["asked"].take(pa.array(row[order] + start)).combine_chunks()
        out.append(pa.Table.from_arrays([names, pa.array(found[order]), pa.array(score[order])], schema=_RESULT))
    return pa.concat_tables(out)


def _place(groups: np.ndarray) -> np.ndarray:
    """Places within groups, from 0, of rows sorted by group."""
    return np.arange(len(groups)) - np.searchsorted(groups, groups)


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` rows with the largest products. Runs jobs at once."""
    raw = F.col(vector_column)
    # Numbers of single precision travel as such and are computed with as doubles.
    kind = "array<float>" if df.schema[vector_column].dataType == ArrayType(FloatType()) else "array<double>"
    rows = df.where(usable(raw) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), is_query.alias("asks"), raw.cast(kind).alias("vector")
    )
    size = F.size("vector")
    lengths = rows.groupBy(size.alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size")
    usual = lengths.first()
    if usual is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    copy = F.md5(F.array_join(F.transform("vector", lambda x: x.cast("double").cast("string")), ","))
    rows = rows.where(size == usual["size"]).withColumn("copy", copy)
    rows = written(rows.dropDuplicates(["id", "copy"]), "vectors")

    # Of copies no result needs more than the k + 1 least ids.
    least = Window.partitionBy("copy").orderBy("id")
    first = rows.withColumn("place", F.row_number().over(least)).where(F.col("place") <= k + 1)
    held = first.groupBy("copy").agg(
        F.array_sort(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector")
    )
    distinct = written(held, "distinct-vectors")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    whole = distinct.agg(F.count("*").alias("n"), F.max(length).alias("longest")).first()

    drawn = distinct.select(F.xxhash64("copy").alias("h"), "copy", "vector").orderBy("h", "copy").limit(SAMPLE)
    sample = np.array([r.vector for r in drawn.select("vector").collect()])
    lists = min(LISTS, -(-whole.n // PER_LIST))
    graph = CentroidGraph(halve(_widened(sample, whole.longest), -(-len(sample) // lists)))

    index = written(assign_lists(distinct, graph, whole.longest), "index")
    held = np.zeros(len(graph.centroids), dtype=np.int64)
    firsts = index.where(F.col("nearest") >= 0)
    for r in firsts.groupBy("nearest").agg(F.count("*").alias("n")).collect():  # a row per list
        held[r["nearest"]] = r["n"]
    asking = written(rows.where("asks").groupBy("copy").agg(F.first("vector").alias("vector")), "asking")
    reach, hops = choose_reach(asking, distinct, index, graph, held, k)
    most = max(NUMBERS // usual["size"], 1)
    sample = firsts.orderBy(F.xxhash64("copy"), "copy").limit(min(most, SAMPLE))
    known = {r.ids[0]: (r.vector, r.nearest) for r in sample.select("ids", "vector", "nearest").collect()}
    known = tuple(np.array(x) for x in zip(*known.values()))
    visits = written(visit_lists(asking, graph, reach, hops, held, k + 1, known), "visits")

    # A shelf's vectors are moved once for each block of its queries, and a query once for each block of a shelf.
    blocks, q_blocks = _blocks(index, most, "blocks"), _blocks(visits.select(F.explode("shelf").alias("shelf")), most, "q_blocks")
    sizes = F.broadcast(written(blocks.join(q_blocks, "shelf"), "blocks"))  # a row per shelf
    each = F.arrays_zip("shelf", "lists")
    visits = visits.select(F.col("copy").alias("asked"), "vector", "floor", F.inline(each)).join(sizes, "shelf")
    part = lambda key, n: F.pmod(F.xxhash64(key), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index.join(sizes, "shelf").select(
        "shelf", part("copy", "blocks").alias("block"), every("q_blocks").alias("q_block"), "ids", "vector", "lists"
    )
    right = visits.select(
        "shelf", every("blocks").alias("block"), part("asked", "q_blocks").alias("q_block"),
        "asked", "vector", "lists", "floor",
    )
    by = ["shelf", "block", "q_block"]
    met = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(
        lambda there, asked: compare(there, asked, k + 1), "asked string, vec_id long, score double"
    )
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    found = met.groupBy("asked", "vec_id").agg(F.max("score").alias("score"))
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    queries = rows.where("asks").select(F.col("id").alias("query_id"), F.col("copy").alias("asked"))
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = queries.join(found, "asked").where(F.col("vec_id") != F.col("query_id"))
    return (
        ranked.withColumn("rank", F.row_number().over(own).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
