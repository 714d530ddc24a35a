"""Approximate nearest neighbours with an inverted multi-index.

The two halves of a vector's direction are quantised separately, each by a codebook of `cells` centroids (k-means on a
bounded sample), so cells * cells pairs of centroids part the space finely at the price of two small codebooks. Beside
its pair, an entry has one of a few classes of length. A pair of centroids in a class is a cell.

Nearness is the largest inner product. What the best entry of a cell can be expected to reach is estimated from the query's
inner products with both centroids, `deviations` times the spread of the directions around them, and the class's greatest
length. Each half has its share of the sum, so a heap yields pairs in the order of their sums, best first, and classes are
merged into that order by another. A query walks in two rounds: first until `first` entries are met, whose exact
scores give its `top`-th best so far; then on, until no cell left is expected to reach that. How much is visited follows
from the vectors: a few percent where they form clusters or differ in length, more than half where 64 random
components leave nothing to go by. With `deviations` infinite every cell is visited and the result is exact.

Spark holds the entries in blocks of about `block`: cells lie end to end in the order of their numbers
and are cut by their entry counts, so small cells share a block and a large one is split. A query goes once to each
block that holds cells of its walk, with their numbers. Blocks and groups of queries meet in one matrix product, of
which each query keeps its `top` best ids, and these are merged by query. The table of entry counts by cell is broadcast:
CLASSES * cells * cells numbers at most.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part.
Defined results: ties go to the smaller id; a query with fewer than `top` candidates gets all of them; vectors with
a null id are no queries and no candidates; a repeated id is one candidate, with the best score of its vectors; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.sample import drawn
from pulsegrid.llm.storage import stored

#: Centroids of each half, most vectors in the sample that they are fitted on, and passes over it.
CELLS, SAMPLE, PASSES = 32, 20_000, 15
#: Entries of the first round, and spreads that an entry may lie beyond its centroids.
FIRST, DEVIATIONS = 1000, 3.1
#: Shares of the sample at which classes of length end, and how much longer the next class has to be.
ENDS, LONGER = (0.25, 0.5, 0.75, 0.9, 0.97, 0.99), 1.05
CLASSES = len(ENDS) + 1
TOP = 20
#: Entries and queries that meet in one task at a time.
BLOCK, QUERIES = 4096, 2048


@dataclass
class Codebooks:
    halves: list[np.ndarray]  # centroids of the first and of the second half of directions
    spreads: list[np.ndarray]  # of each centroid: root of the mean square of a component of what it leaves over
    ends: np.ndarray  # lengths at which a class ends

    @property
    def dimensions(self) -> int:
        return sum(h.shape[1] for h in self.halves)

    @property
    def pairs(self) -> int:
        return len(self.halves[0]) * len(self.halves[1])

    @property
    def size(self) -> int:
        return self.pairs * (len(self.ends) + 1)

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and length of each vector."""
        length = np.linalg.norm(vectors, axis=1)
        cut = self.halves[0].shape[1]
        way = vectors / length[:, None]
        first, second = (_nearest(part, h) for part, h in
                         zip((way[:, :cut], way[:, cut:]), self.halves, strict=True))
        return np.searchsorted(self.ends, length) * self.pairs + first * len(self.halves[1]) + second, length

    def by_sum(self, query: np.ndarray, deviations: float) -> Iterator[tuple[float, int]]:
        """Sum and number of each pair, from the largest sum down."""
        cut = self.halves[0].shape[1]
        # The spreads of both halves add up in squares; the sum of both over the root of two is that where they are equal.
        parts = [h @ part + deviations / 2**0.5 * np.linalg.norm(part) * s if np.isfinite(deviations) else h @ part
                 for h, s, part in zip(self.halves, self.spreads, (query[:cut], query[cut:]), strict=True)]
        orders = [np.argsort(-p, kind="stable") for p in parts]
        near = [p[o] for p, o in zip(parts, orders, strict=True)]
        heap = [(-(near[0][0] + near[1][0]), 0, 0)]
        while heap:
            cost, i, j = heapq.heappop(heap)
            yield -cost, int(orders[0][i]) * len(near[1]) + int(orders[1][j])
            # (i, j) brings up its neighbours once: (i, j + 1) always, (i + 1, j) from the first column.
            if j + 1 < len(near[1]):
                heapq.heappush(heap, (-(near[0][i] + near[1][j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(near[0]):
                heapq.heappush(heap, (-(near[0][i + 1] + near[1][0]), i + 1, 0))

    def walk(self, query: np.ndarray, lengths: np.ndarray, deviations: float) -> Iterator[tuple[float, int]]:
        """What a cell is expected to reach and its number, from the best cell down; `lengths` holds the least and
        greatest length in each class."""
        pairs, known = self.by_sum(query, deviations), []

        def reach(kind: int, place: int) -> float | None:
            while len(known) <= place:
                following = next(pairs, None)
                if following is None:
                    return None
                known.append(following)
            total = known[place][0]
            return total * lengths[kind][1 if total > 0 else 0]

        heads = [(-reach(kind, 0), kind, 0) for kind in range(len(lengths))]
        heapq.heapify(heads)
        while heads:
            cost, kind, place = heapq.heappop(heads)
            yield -cost, kind * self.pairs + known[place][1]
            following = reach(kind, place + 1)
            if following is not None:
                heapq.heappush(heads, (-following, kind, place + 1))

    def visited(self, query: np.ndarray, counts: np.ndarray, lengths: np.ndarray, deviations: float, first: int,
                least: float | None = None) -> list[int]:
        """Cells of the first round; with `least`, those of the second, which may reach it."""
        met, out = 0, []
        for reached, cell in self.walk(query, lengths, deviations):
            if least is None and met >= first:
                break
            if least is not None and met >= first and reached < least and np.isfinite(deviations):
                break
            if counts[cell]:
                if (met < first) == (least is None):
                    out.append(cell)
                met += counts[cell]
        return out


def _nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(1) - 2 * vectors @ centroids.T).argmin(1)


def fit(vectors: np.ndarray, cells: int = CELLS, seed: int = 11) -> Codebooks:
    """K-means of each half of the directions, and classes of length. Fewer distinct halves than cells give fewer
    centroids."""
    rng = np.random.default_rng(seed)
    cut = vectors.shape[1] // 2
    length = np.linalg.norm(vectors, axis=1)
    way = vectors / length[:, None]
    out, spreads = [], []
    for half in (way[:, :cut], way[:, cut:]):
        distinct = np.unique(half, axis=0)
        centroids = distinct[np.sort(rng.choice(len(distinct), min(cells, len(distinct)), replace=False))]
        for _ in range(PASSES):
            at = _nearest(distinct, centroids)
            sums = np.zeros_like(centroids)
            np.add.at(sums, at, distinct)
            n = np.bincount(at, minlength=len(centroids))
            centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
        at = _nearest(distinct, centroids)
        left = ((distinct - centroids[at]) ** 2).mean(1)
        n = np.bincount(at, minlength=len(centroids))
        mean = np.bincount(at, left, len(centroids)) / np.maximum(n, 1)
        spreads.append(np.sqrt(np.where(n > 1, mean, left.mean())))  # one vector says nothing about a spread
        out.append(centroids)
    ends: list[float] = []
    for end in [*np.quantile(length, ENDS), length.max()]:
        if not ends or end > LONGER * ends[-1]:
            ends.append(float(end))
    return Codebooks(out, spreads, np.array(ends[:-1]))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and vector (doubles) of the rows that take part, but for their length."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(key).isNotNull() & F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))) \
        .select(F.col(key).cast("long").alias("id"), v.alias("vector"))


def _matrix(column: pa.Array | pa.ChunkedArray, dimensions: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


class Layout:
    """Blocks of the index, from the entry counts of pairs."""

    def __init__(self, counts: np.ndarray, block: int):
        self.counts = counts
        begin = np.cumsum(counts) - counts
        self.first = begin // block
        self.parts = np.maximum(begin + counts - 1, begin) // block - self.first + 1

    def block_of(self, cells: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Rows of one id in a cell are dealt by their vectors."""
        odd = np.arange(vectors.shape[1], dtype=np.uint64) * np.uint64(0xD1342543DE82EF96) + np.uint64(1)
        bits = (np.ascontiguousarray(vectors, np.float64).view(np.uint64) * odd).sum(1, dtype=np.uint64)
        mixed = (ids.astype(np.uint64) ^ bits ^ bits >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        return self.first[cells] + (mixed % self.parts[cells].astype(np.uint64)).astype(np.int64)

    def visits(self, cells: list[int]) -> dict[int, list[int]]:
        """Cells of a walk by block."""
        out: dict[int, list[int]] = {}
        for cell in cells:
            for block in range(self.first[cell], self.first[cell] + self.parts[cell]):
                out.setdefault(block, []).append(cell)
        return out


def _best(block: pa.Table, queries: pa.Table, dimensions: int, top: int) -> pa.Table:
    """The best ids of the block for each query, among the cells that it visits."""
    names = ["query_id", "vec_id", "score"]
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if block.num_rows and queries.num_rows:
        block = block.sort_by("id")  # the entries of an id lie side by side
        ids, cells = block["id"].to_numpy(), block["cell"].to_numpy()
        known, cells = np.unique(cells, return_inverse=True)
        entries, asked = _matrix(block["vector"], dimensions), _matrix(queries["vector"], dimensions)
        rough = asked @ entries.T
        for row, (query, visited) in enumerate(zip(queries["id"].to_pylist(), queries["cells"], strict=True)):
            there = np.isin(known, visited.values.to_numpy())[cells] & (ids != query)
            places = np.flatnonzero(there)
            line = rough[row][places]
            if len(line) > top:
                own = ids[places]
                of_id = np.maximum.reduceat(line, np.flatnonzero(np.append(True, own[1:] != own[:-1])))
                # The product's last digits depend on its shape: keep whatever may belong to the best.
                limit = np.partition(of_id, len(of_id) - top)[len(of_id) - top] if len(of_id) > top else of_id.min()
                places = places[line >= limit - 1e-9 * max(1.0, abs(limit))]
            exact = (asked[row] * entries[places]).sum(1)
            order = np.lexsort((ids[places], -exact))
            order = order[np.sort(np.unique(ids[places[order]], return_index=True)[1])][:top]
            out.append((np.full(len(order), query), ids[places[order]], exact[order]))
    return pa.table([np.concatenate(x) for x in zip(*out, strict=True)], names=names)


def build(vectors: DataFrame, cells: int = CELLS, sample: int = SAMPLE) -> tuple[Codebooks | None, DataFrame]:
    """Codebooks fitted on the `sample` vectors whose ids hash lowest, and the entries that have their length."""
    rows = drawn(vectors, sample, "id").collect()
    if not rows:
        return None, vectors
    lengths = [len(r["vector"]) for r in rows]
    dimensions = max(sorted(set(lengths)), key=lengths.count)
    if dimensions < 2:
        raise ValueError("an inverted multi-index needs vectors of two components or more")
    fitted = fit(np.array([r["vector"] for r in rows if len(r["vector"]) == dimensions]), cells)
    return fitted, vectors.where(F.size("vector") == dimensions)


def search(vectors: DataFrame, key: str, vector: str, is_query: str, top: int = TOP, cells: int = CELLS,
           first: int = FIRST, deviations: float = DEVIATIONS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the `top` nearest entries found for each row that meets `is_query`, a condition
    on the column `id`."""
    spark = vectors.sparkSession
    # Copies of a row meet in the task before they are sent; one entry stays.
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector")).where("id is not null")
    books, entries = build(usable(stored(rows.dropDuplicates(), "vectors"), "id", "vector"), cells)
    if books is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(books)

    def assigned(batches):
        for batch in batches:
            if batch.num_rows:
                cell, length = shared.value.assign(_matrix(batch["vector"], shared.value.dimensions))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64()), pa.array(length)],
                                                 names=[*batch.schema.names, "cell", "length"])

    index = entries.mapInArrow(assigned, "id long, vector array<double>, cell long, length double")
    counts = np.zeros(books.size, np.int64)
    lengths = np.tile([np.inf, 0.0], (len(books.ends) + 1, 1))
    for r in index.groupBy("cell").agg(F.count("*").alias("n"), F.min("length").alias("least"),
                                       F.max("length").alias("most")).collect():
        counts[r["cell"]], kind = r["n"], r["cell"] // books.pairs
        lengths[kind] = min(lengths[kind][0], r["least"]), max(lengths[kind][1], r["most"])
    lengths[lengths[:, 1] == 0] = 0.0  # a class without entries
    layout = spark.sparkContext.broadcast(Layout(counts, block))
    asked = entries.where(is_query)
    groups = int(asked.count() // QUERIES + 1)

    def placed(batches):
        for batch in batches:
            vectors = _matrix(batch["vector"], shared.value.dimensions)
            blocks = layout.value.block_of(batch["cell"].to_numpy(), batch["id"].to_numpy(), vectors)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(blocks)],
                                             names=[*batch.schema.names[:3], "block"])

    def visits(batches):
        books = shared.value
        for batch in batches:
            found = _matrix(batch["vector"], books.dimensions) if batch.num_rows else []
            known = batch["least"].to_pylist() if "least" in batch.schema.names else [None] * len(found)
            for row, query in enumerate(found):
                cells = books.visited(query, layout.value.counts, lengths, deviations, first, known[row])
                by_block = layout.value.visits(cells)
                whole = batch.select(["id", "vector"]).slice(row, 1).take(pa.array(np.zeros(len(by_block), np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [*whole.columns, pa.array(list(by_block.values()), pa.list_(pa.int64())),
                     pa.array([int(b) for b in by_block], pa.int64())],
                    names=["id", "vector", "cells", "block"])

    dealt = index.mapInArrow(placed, "id long, vector array<double>, cell long, block long").withColumn(
        "queries", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dimensions = books.dimensions
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))

    def ranked(near: DataFrame) -> DataFrame:
        best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return best.withColumn("rank", rank).where(F.col("rank") <= top)

    def met(asking: DataFrame) -> DataFrame:
        visiting = asking.mapInArrow(
            visits, "id long, vector array<double>, cells array<long>, block long"
        ).withColumn("queries", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
        return dealt.groupBy("block", "queries").cogroup(visiting.groupBy("block", "queries")).applyInArrow(
            lambda entries, queries: _best(entries, queries, dimensions, top), "query_id long, vec_id long, score double")

    near = stored(ranked(met(asked)).drop("rank"), "first-round")
    least = near.groupBy(F.col("query_id").alias("id")).agg(
        F.when(F.count("*") == top, F.min("score")).otherwise(float("-inf")).alias("least"))
    again = asked.join(least, "id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    return ranked(near.unionByName(met(again))).select("query_id", "rank", "vec_id", "score")
