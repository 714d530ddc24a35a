"""Hard negatives for anchors, from candidate blocks in the order of a Hilbert curve.

Vectors become integers (floor of `SCALE` times each component), so every score is exact. Candidates are sorted along a
Hilbert curve through the main directions of a bounded sample (they decide the order only, not a result) and stored as
Parquet blocks of `BLOCK` rows, each with a zone map: the least and the greatest value of each dimension.

Interval arithmetic on a zone map bounds the scores that an anchor can have in a block: each component counts with
the end of the interval that its sign asks for. A window is what is still to be found for an anchor: its best rows of
the same label first, then for each of these positives the best rows of other labels whose score lies between two shares
of the positive's. A block is read for a window only if the bounds meet it and can beat what it has; to begin with,
positives have the scores that the anchor's own block gives.

Two passes, one for positives and one for negatives. Each plans first, from zone maps alone, which blocks any window of
a group of anchors must read, and then joins these, stripe by stripe, to the group. A stripe is some neighbouring blocks
and a group some thousand anchors of neighbouring stripes, so what meets in a task is bounded. Windows that tie a hot
group of equal vectors are not special: equal vectors lie in many blocks, and each block gives a window its best few.

Rows with a null id, label, vector or component, or with a component that is not finite, take no part. Defined results: a
row that is repeated whole counts once; rows of one id are no candidates of each other; a missing component of a shorter
vector counts as 0; ties go to the smaller id; an empty table gives an empty result. Scores must fit in 64 bits.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.sample import drawn
from pulsegrid.llm.storage import shared_folder, stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score between which a negative's must lie.
LOW, HIGH = 30, 90
#: Rows of a block, blocks of a stripe, anchors of a group.
BLOCK, STRIPE, GROUP = 1024, 16, 16_384
#: Directions and bits of the Hilbert curve, and rows that the directions are taken from.
DIRECTIONS, BITS, SAMPLE = 8, 6, 4096
_SLICE = 2048
_FIRST, _LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers below 2**bits (Skilling's transposed form)."""
    x = cells.astype(np.uint64).T.copy()
    top = 1 << (bits - 1)
    for q in (np.uint64(1 << b) for b in range(bits - 1, 0, -1)):
        low = q - np.uint64(1)
        for row in x:
            turned = (row & q) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ row) & low)
            x[0] ^= np.where(turned, low, swap)
            row ^= swap if row is not x[0] else np.uint64(0)
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    q = top
    while q > 1:
        flip ^= np.where((x[-1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= flip
    place = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for row in x:
            place = place << np.uint64(1) | row >> np.uint64(b) & np.uint64(1)
    return place.astype(np.int64)


@dataclass
class Curve:
    centre: np.ndarray
    directions: np.ndarray  # dimensions by directions
    cuts: np.ndarray  # of each direction, where its cells end

    @classmethod
    def through(cls, vectors: np.ndarray) -> Curve:
        centre = vectors.mean(0)
        _, _, axes = np.linalg.svd(vectors - centre, full_matrices=False)
        directions = axes[:DIRECTIONS].T
        ends = np.linspace(0, 1, (1 << BITS) + 1)[1:-1]
        return cls(centre, directions, np.quantile((vectors - centre) @ directions, ends, axis=0).T)

    def places(self, vectors: np.ndarray) -> np.ndarray:
        along = (vectors - self.centre) @ self.directions
        cells = [np.searchsorted(c, a, side="right") for c, a in zip(self.cuts, along.T, strict=True)]
        return hilbert(np.stack(cells, 1), BITS)


def usable(vectors: DataFrame, key: str, label: Column, vector: str, scale: int = SCALE) -> DataFrame:
    """id, label and vector (integers) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(key).isNotNull() & label.isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col(key).cast("long").alias("id"), label.cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x * scale)).alias("vector")).dropDuplicates()


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Integer vectors as rows, filled up with 0."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dimensions), np.int64)
    out[np.arange(dimensions) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers, by floating point where that is exact."""
    if not (a.size and b.size):
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible score of each row of `a` in each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return _product(up, low) + _product(down, high), _product(up, high) + _product(down, low)


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k entries of each group: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    own = group[order]
    begins = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(begins, np.diff(np.append(begins, len(own))))
    return order[rank < k]


class Windows:
    """Windows of some anchors, and what has been found for them."""

    def __init__(self, anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, owner: np.ndarray, low: np.ndarray,
                 high: np.ndarray, floor: np.ndarray, same: bool, k: int):
        self.anchors, self.ids, self.labels, self.owner = anchors, ids, labels, owner
        self.low, self.high, self.floor = low, high, floor  # scores; `floor`: a lower one can't be among the first k
        self.same, self.k = same, k
        self.found = [np.zeros(0, np.int64)] * 3  # window, score, id

    def meeting(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Windows by boxes: whether the bounds meet."""
        least, most = bounds(self.anchors, low, high)
        least, most = least[self.owner], most[self.owner]
        return (most >= np.maximum(self.low, self.floor)[:, None]) & (least <= self.high[:, None])

    def read(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        asked = np.flatnonzero(self.meeting(low[None, :], high[None, :])[:, 0])
        for begin in range(0, len(asked), _SLICE):
            part = asked[begin : begin + _SLICE]
            anchors, row = np.unique(self.owner[part], return_inverse=True)
            score = _product(self.anchors[anchors], vectors)[row]
            own = self.owner[part]
            fits = (labels[None, :] == self.labels[own][:, None]) == self.same
            fits &= ids[None, :] != self.ids[own][:, None]
            fits &= (score >= np.maximum(self.low, self.floor)[part][:, None]) & (score <= self.high[part][:, None])
            if len(ids) > self.k:
                held = np.where(fits, score, _FIRST)
                fits &= score >= np.partition(held, len(ids) - self.k, axis=1)[:, len(ids) - self.k][:, None]
            at, place = np.nonzero(fits)
            self._keep(part[at], score[at, place], ids[place])

    def _keep(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(window):
            return
        window, score, ids = (np.concatenate(x) for x in zip(self.found, (window, score, ids), strict=True))
        best = _first(window, score, ids, self.k)
        self.found = [window[best], score[best], ids[best]]
        full = np.bincount(self.found[0], minlength=len(self.owner)) == self.k
        least = np.full(len(self.owner), _LAST)
        np.minimum.at(least, self.found[0], self.found[1])
        self.floor = np.where(full, np.maximum(least, self.floor), self.floor)


_BLOCK_SQL = ("anchors boolean, stripe int, block long, ids binary, labels binary, vectors binary, wide boolean, "
              "low array<long>, high array<long>, floors binary")


def _packed(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray,
            floors: np.ndarray, anchors: bool, stripe: int, block: int) -> pa.RecordBatch:
    wide = bool(vectors.size) and bool(np.abs(vectors).max() >= 2**31)
    kept = vectors if wide else vectors.astype(np.int32)
    row = [anchors, stripe, block, ids.tobytes(), labels.tobytes(), kept.tobytes(), wide, low.tolist(), high.tolist(),
           floors.tobytes()]
    kinds = [pa.bool_(), pa.int32(), pa.int64(), *[pa.binary()] * 3, pa.bool_(), *[pa.list_(pa.int64())] * 2, pa.binary()]
    names = [c.split()[0] for c in _BLOCK_SQL.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)


def _ints(blob: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(blob, kind)


def _vectors(row: dict, dimensions: int) -> np.ndarray:
    n = len(row["ids"]) // 8
    return _ints(row["vectors"], np.int64 if row["wide"] else np.int32).astype(np.int64).reshape(n, dimensions)


def store_blocks(rows: DataFrame, is_anchor: str, curve: Curve, dimensions: int, count: int, positives: int,
                 block: int) -> tuple[DataFrame, DataFrame]:
    """The candidate blocks and the anchors, a row for the anchors of each block, along the curve."""
    shared = rows.sparkSession.sparkContext.broadcast(curve)

    def placed(batches):
        for batch in batches:
            at = shared.value.places(_matrix(batch["vector"], dimensions)) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=[*batch.schema.names, "place"])

    def blocks_of(batches):
        stripe, number, held = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= block:
                table = pa.Table.from_batches(held)
                yield from made(table.slice(0, block), stripe, number)
                number, held = number + 1, table.slice(block).to_batches()
        if sum(b.num_rows for b in held):
            yield from made(pa.Table.from_batches(held), stripe, number)

    def made(table, stripe, number):
        table = table.combine_chunks().sort_by("id")
        ids, labels = table["id"].to_numpy(), table["label"].to_numpy()
        vectors = _matrix(table["vector"].combine_chunks(), dimensions)
        low, high = vectors.min(0), vectors.max(0)
        name = stripe << 32 | number
        none = np.zeros(0, np.int64)
        yield _packed(ids, labels, vectors, low, high, none, False, stripe, name)
        chosen = np.flatnonzero(table["anchor"].to_numpy(zero_copy_only=False))
        if len(chosen):
            all_of = np.arange(len(chosen))
            own = Windows(vectors[chosen], ids[chosen], labels[chosen], all_of, np.full(len(chosen), _FIRST),
                          np.full(len(chosen), _LAST), np.full(len(chosen), _FIRST), True, positives)
            own.read(ids, labels, vectors, low, high)
            yield _packed(ids[chosen], labels[chosen], vectors[chosen], low, high, own.floor, True, stripe, name)

    schema = "id long, label long, vector array<long>, anchor boolean"
    along = rows.withColumn("anchor", F.coalesce(F.expr(is_anchor), F.lit(False))).mapInArrow(
        placed, f"{schema}, place long")
    stripes = max(1, math.ceil(count / (block * STRIPE)))
    packed = along.repartitionByRange(stripes, "place", "id", "label", "vector").sortWithinPartitions("place", "id").mapInArrow(
        blocks_of, _BLOCK_SQL)
    path = f"{shared_folder(rows.sparkSession)}/candidates-{uuid.uuid4().hex}"
    packed.write.partitionBy("anchors").parquet(path)
    read = rows.sparkSession.read.schema(_BLOCK_SQL.replace("anchors boolean, ", "") + ", anchors boolean").parquet(path)
    return read.where("NOT anchors").drop("anchors", "floors"), read.where("anchors").drop("anchors")


def _of(batch: pa.Table, dimensions: int, same: bool, k: int) -> Windows:
    """Windows of a group: one row an anchor, with lists of the windows' lowest and highest scores."""
    counts = pa.compute.list_value_length(batch["low"]).to_numpy()
    flat = lambda c: batch[c].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(batch.num_rows), counts)
    return Windows(_matrix(batch["vector"].combine_chunks(), dimensions), batch["id"].to_numpy(),
                   batch["label"].to_numpy(), owner, flat("low"), flat("high"), batch["floor"].to_numpy()[owner], same, k)


def _pass(windows: DataFrame, blocks: DataFrame, dimensions: int, groups: int, same: bool, k: int) -> DataFrame:
    """anchor, window (its number in the anchor's lists), score and found (an id): the first k of each window."""
    zones = blocks.select("stripe", "block", "low", "high")
    last = zones.agg(F.max("stripe")).first()[0]
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n))).alias(name)
    cell = ["group", "stripe"]

    def planned(left: pa.Table, right: pa.Table) -> pa.Table:
        out = pa.table({c: pa.array([], t) for c, t in (("group", pa.int32()), ("block", pa.int64()))})
        if left.num_rows and right.num_rows:
            box = [_matrix(right[c].combine_chunks(), dimensions) for c in ("low", "high")]
            asked = _of(left, dimensions, same, k)
            met = np.zeros(right.num_rows, bool)
            for begin in range(0, len(asked.owner), _SLICE):
                some = Windows(asked.anchors, asked.ids, asked.labels, *[x[begin : begin + _SLICE] for x in (
                    asked.owner, asked.low, asked.high, asked.floor)], same, k)
                met |= some.meeting(*box).any(0)
            wanted = right["block"].to_numpy()[met]
            out = pa.table({"group": pa.array([left["group"][0].as_py()] * len(wanted), pa.int32()), "block": wanted})
        return out

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 4
        if left.num_rows and right.num_rows:
            asked = _of(left, dimensions, same, k)
            for row in right.to_pylist():
                asked.read(_ints(row["ids"]), _ints(row["labels"]), _vectors(row, dimensions),
                           np.array(row["low"], np.int64), np.array(row["high"], np.int64))
            window, score, ids = asked.found
            begin = np.searchsorted(asked.owner, asked.owner[window])
            out = [left["anchor"].to_numpy()[asked.owner[window]], window - begin, score, ids]
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["anchor", "window", "score", "found"])

    plan = windows.select("*", every(last, "stripe")).groupBy(*cell).cogroup(
        zones.select("*", every(groups - 1, "group")).groupBy(*cell)).applyInArrow(planned, "group int, block long")
    plan = stored(plan, "wanted-blocks")
    wanted = blocks.join(plan, "block")
    asking = windows.join(plan.select("group", F.shiftright("block", 32).cast("int").alias("stripe")).distinct(), "group")
    near = asking.groupBy(*cell).cogroup(wanted.groupBy(*cell)).applyInArrow(
        searched, "anchor long, window long, score long, found long")
    rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "found"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(vectors: DataFrame, key: str, label: Column, vector: str, is_anchor: str, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK,
         group: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row that meets `is_anchor` (a
    condition on `id`) and each of its `positives` best rows of the same label, the `negatives` best rows of other
    labels with a score between `low` and `high` percent of the positive's."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors, key, label, vector), "integer-vectors")
    count, dimensions, anchors = rows.agg(
        F.count("*"), F.max(F.size("vector")), F.count_if(F.expr(is_anchor))).first()
    if not count or not anchors:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    dimensions = max(dimensions, 1)
    sample = drawn(rows, SAMPLE, "id").select("vector").toArrow()["vector"].combine_chunks()
    curve = Curve.through(_matrix(sample, dimensions).astype(np.float64))
    blocks, chosen = store_blocks(rows, is_anchor, curve, dimensions, count, positives, block)
    groups = math.ceil(anchors / group)
    stripes = max(1, math.ceil(count / (block * STRIPE)))

    def unpacked(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n, first = len(row["ids"]) // 8, row["block"] * block
                own = _vectors(row, dimensions)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(first, first + n)), pa.array([min(groups - 1, row["stripe"] * groups // stripes)] * n,
                                                                     pa.int32()),
                     pa.array(_ints(row["ids"])), pa.array(_ints(row["labels"])),
                     pa.ListArray.from_arrays(np.arange(0, own.size + 1, dimensions, dtype=np.int32), own.ravel()),
                     pa.array(_ints(row["floors"]))], names=["anchor", "group", "id", "label", "vector", "floor"])

    asking = chosen.mapInArrow(
        unpacked, "anchor long, group int, id long, label long, vector array<long>, floor long")
    bound = lambda n: F.array(F.lit(int(n)).cast("long"))
    first = _pass(asking.withColumns({"low": bound(_FIRST), "high": bound(_LAST)}), blocks, dimensions, groups, True,
                  positives)
    ranked = F.transform(F.sort_array(F.collect_list(F.struct("rank", "found", "score"))), lambda p: F.struct(
        p["found"].alias("found"), p["score"].alias("score")))
    found = stored(first.groupBy("anchor").agg(ranked.alias("positives")), "positives")
    # 100 n >= low p and 100 n <= high p, in whole numbers.
    least = F.transform("positives", lambda p: F.ceil((p["score"] * low).cast("decimal(25,0)") / 100).cast("long"))
    most = F.transform("positives", lambda p: F.floor((p["score"] * high).cast("decimal(25,0)") / 100).cast("long"))
    second = asking.join(found, "anchor").select(
        "anchor", "group", "id", "label", "vector", F.lit(_FIRST).cast("long").alias("floor"), least.alias("low"),
        most.alias("high"))
    near = _pass(second, blocks, dimensions, groups, False, negatives)
    positive = F.get("positives", F.col("window").cast("int"))
    return near.join(found.join(asking.select("anchor", "id"), "anchor"), "anchor").select(
        F.col("id").alias("anchor_id"), positive["found"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("found").alias("negative_id"), positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"))
