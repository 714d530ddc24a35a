"""The prefix trie of conversations, by a skeleton of splitters.

A turn is an item of 20 bytes: 16 of the SHA-256 of role and text, and the number of UTF-8 bytes of its text. A
conversation is the path of its items, one byte string, so the order of paths is the order of the trie. Equal
paths are one class, with their ids in blocks of neighbouring numbers: a path that very many conversations share
is a few rows, none of them large.

Splitters are separators between sampled paths, cut to the first item that tells one from the path before. They part
all paths into shards of about `shard_bytes`. A node whose conversations lie in several shards is a prefix of a
splitter, so the trie of the splitters' paths, the skeleton, is broadcast, and
each shard, sorted by path, finishes every other node by itself: it reads its classes in order and keeps open only
the path that it is on, and the finished children of open nodes that wait for their parent's smallest id. For nodes of
the skeleton it gives partial counts. These are summed by node, and one pass over the skeleton gives the rest.

The skeleton is the only thing that goes through the driver and to all tasks: at most `SHARDS` splitters and
`SKELETON_BYTES` of their paths. Where the splitters are more than that, every second one is dropped until they fit;
shards are larger then, and results the same. A conversation's path must fit in one row: 2 GB are 100 million turns.

Rows without a conversation id take no part. Defined results: turns are ordered by turn (null first), then role, then
digest; repeated rows are turns of their own; a null role or text is an empty one; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.storage import stored

ITEM = 20
#: Path bytes of a shard, and bounds of the skeleton.
SHARD_BYTES, LEAST_SHARDS, SHARDS, SKELETON_BYTES = 1 << 20, 32, 16_384, 16 << 20
#: Sampled paths for each shard; longer ones are no splitters.
SAMPLED, LONGEST = 8, 1 << 16
SAMPLE_BYTES = 64 << 20
#: Conversation ids that agree but for their last bits lie in one block.
BLOCK_BITS = 12
_RANGE = 1 << 30
_FLUSH = 20_000

NODE = pa.schema([
    ("skeleton", pa.int32()), ("parent", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
])
_NODE_SQL = ("skeleton int, parent int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
             "n_leaves long, saved_tokens long, ends_sha256 string")
RESULT = NODE.names[2:]
NONE_END = hashlib.sha256(b"").hexdigest()


def items(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role and the turn's item in hexadecimal digits."""
    said = F.coalesce(F.col(text), F.lit(""))
    who = F.coalesce(F.col(role), F.lit(""))
    digest = F.substring(F.sha2(F.concat_ws(":", F.octet_length(who).cast("string"), who, said), 256), 1, 32)
    return turns.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"), F.col(turn).alias("turn"), who.alias("role"),
        F.concat(digest, F.lpad(F.hex(F.octet_length(said)), 8, "0")).alias("item"))


def _path(items: Column) -> Column:
    return F.unhex(F.array_join(items, ""))


def rebuilt(rows: DataFrame, group: Column, taken: Column, longest: int) -> DataFrame:
    """conv and path, where each conversation begins with the first `taken` turns of the conversation `group` names
    (all, if fewer; none, if absent), at most `longest`, and goes on with its own turns after its first `taken`."""
    one = F.struct("turn", "role", "item")
    whole = rows.withColumn("base", group).repartition("base").groupBy("base", "conv").agg(
        F.transform(F.sort_array(F.collect_list(one)), lambda t: t["item"]).alias("items"))
    head = F.when(F.col("conv") == F.col("base"), F.slice("items", 1, longest))
    first = F.max(head).over(Window.partitionBy("base"))
    return whole.withColumn("first", F.coalesce(first, F.array().cast("array<string>"))).withColumn(
        "h", taken.cast("int")).select("conv", _path(F.concat(
            F.slice("first", F.lit(1), F.col("h")),
            F.slice("items", F.col("h") + 1, F.greatest(F.size("items") - F.col("h"), F.lit(0))))).alias("path"))


def classes(paths: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """path, block and the ids of the conversations of that path in that block, in numeric order."""
    block = F.shiftright(F.col("conv"), bits)
    return paths.withColumn("block", block).groupBy("path", "block").agg(
        F.sort_array(F.collect_list("conv")).alias("convs"))


@dataclass
class Skeleton:
    splitters: list[bytes]
    ids: list[list[int]]  # of each splitter, the node at each depth; 0 is the root
    parent: list[int]
    depth: list[int]
    last: list[int]  # bytes of a node's last text

    @classmethod
    def of(cls, splitters: list[bytes]) -> Skeleton:
        made = cls(splitters, [], [-1], [0], [0])
        before, path = b"", [0]
        for s in splitters:
            path = path[: _shared(before, s) + 1]
            for at in range(len(path) - 1, len(s) // ITEM):
                made.parent.append(path[-1])
                made.depth.append(at + 1)
                made.last.append(_text_bytes(s, at))
                path.append(len(made.parent) - 1)
            made.ids.append(list(path))
            before = s
        return made

    def shard(self, path: bytes) -> int:
        return bisect_right(self.splitters, path)

    def along(self, shard: int, path: bytes) -> list[int]:
        """Skeleton nodes on a path of the shard, from the root. Its prefixes of a splitter are those of the two
        splitters beside the shard."""
        best = [0]
        for i in (shard - 1, shard):
            if 0 <= i < len(self.splitters):
                n = _shared(self.splitters[i], path)
                if n >= len(best):
                    best = self.ids[i][: n + 1]
        return best


def _shared(a: bytes, b: bytes) -> int:
    """Items that two paths begin with in common."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // ITEM
    at = 0
    while a[at : at + ITEM] == b[at : at + ITEM]:
        at += ITEM
    return at // ITEM


def _text_bytes(path: bytes, at: int) -> int:
    return int.from_bytes(path[at * ITEM + 16 : (at + 1) * ITEM], "big")


def separators(sample: list[bytes], shards: int, most: int = SKELETON_BYTES) -> list[bytes]:
    """At most `shards - 1` splitters at even ranks of the sorted, distinct sample."""
    sample = sorted(set(sample))
    at = sorted({len(sample) * i // shards for i in range(1, shards)} - {0})
    found = [sample[i][: (_shared(sample[i - 1], sample[i]) + 1) * ITEM] for i in at]
    while sum(map(len, found)) > most:
        found = found[1::2]
    return found


class _Node:
    __slots__ = ("children", "end", "last", "least", "leaves", "n", "saved", "skeleton", "waiting")

    def __init__(self, skeleton: int, last: int):
        self.skeleton, self.last = skeleton, last  # skeleton: number there, or -1
        self.n, self.least, self.children, self.leaves, self.saved = 0, None, 0, 0, 0
        self.end, self.waiting = None, []


class _Shard:
    """Nodes of one shard, as its classes come by in the order of their paths."""

    def __init__(self):
        self.out: list[tuple] = []
        self.shard, self.path, self.open = None, b"", []

    def take(self, skeleton: Skeleton, shard: int, path: bytes, convs: list[int]) -> None:
        if shard != self.shard:
            self.close(0)
            self.shard, self.path, self.open = shard, b"", [_Node(0, 0)]
        elif path != self.path:
            self.close(_shared(self.path, path) + 1)
        if len(self.open) <= len(path) // ITEM:
            known = skeleton.along(shard, path)
            for at in range(len(self.open) - 1, len(path) // ITEM):
                self.open.append(_Node(known[at + 1] if at + 1 < len(known) else -1, _text_bytes(path, at)))
        self.path = path
        node = self.open[-1]
        if node.end is None:
            node.end = hashlib.sha256()
        elif node.n:
            node.end.update(b",")
        node.end.update(",".join(map(str, convs)).encode())
        node.n += len(convs)
        node.least = convs[0] if node.least is None else min(node.least, convs[0])

    def close(self, keep: int) -> None:
        """Finish open nodes until `keep` of them are left."""
        while len(self.open) > keep:
            node, depth = self.open.pop(), len(self.open)
            for row in node.waiting:
                self.out.append((*row[:4], node.least, *row[5:]))
            end = node.end.hexdigest() if node.end else None
            if node.skeleton >= 0:
                self.out.append((node.skeleton, None, node.least, depth, None, node.n, node.children, node.leaves,
                                 node.saved, end))
            else:
                node.leaves += not node.children
                node.saved += (node.n - 1) * node.last
                above = self.open[-1]
                row = (None, above.skeleton if above.skeleton >= 0 else None, node.least, depth, None, node.n,
                       node.children, node.leaves, node.saved, end or NONE_END)
                (self.out if above.skeleton >= 0 else above.waiting).append(row)
                above.children += 1
                above.leaves += node.leaves
                above.saved += node.saved
            if self.open:
                above = self.open[-1]
                above.n += node.n
                above.least = node.least if above.least is None else min(above.least, node.least)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.out), _FLUSH):
            part = self.out[at : at + _FLUSH]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), NODE, strict=True)], schema=NODE)
        self.out = []


def _sampled(groups: DataFrame, shards: int, total: int, n: int) -> list[bytes]:
    """Paths of classes that hash lowest, about `SAMPLED` a shard and `SAMPLE_BYTES` at most."""
    share = min(1.0, SAMPLED * shards / max(n, 1), SAMPLE_BYTES / max(total, 1))
    drawn = groups.where((F.octet_length("path") <= LONGEST) & (
        F.pmod(F.xxhash64("path"), F.lit(_RANGE)) <= math.ceil(share * _RANGE)))
    return [bytes(r["path"]) for r in drawn.select("path").distinct().toLocalIterator()]


def nodes(paths: DataFrame, shard_bytes: int = SHARD_BYTES, bits: int = BLOCK_BITS,
          least_shards: int = LEAST_SHARDS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of each node of the
    trie of `paths` (conv, path)."""
    spark = paths.sparkSession
    groups = stored(classes(paths, bits), "trie-classes")
    n, total = groups.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("path")), F.lit(0))).first()
    shards = min(SHARDS, max(least_shards, math.ceil(total / shard_bytes)))
    skeleton = Skeleton.of(separators(_sampled(groups, shards, total, n), shards))
    shared = spark.sparkContext.broadcast(skeleton)

    def dealt(batches):
        for batch in batches:
            of = shared.value.shard
            shard = pa.array([of(p) for p in batch["path"].to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, *batch.columns], names=["shard", *batch.schema.names])

    def finished(batches):
        state = _Shard()
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("shard", "path", "convs")), strict=True):
                state.take(shared.value, *row)
                if len(state.out) >= _FLUSH:
                    yield from state.rows()
        state.close(0)
        yield from state.rows()

    placed = groups.mapInArrow(dealt, "shard int, path binary, block long, convs array<long>")
    found = stored(
        placed.repartitionById(len(skeleton.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "block")
        .mapInArrow(finished, _NODE_SQL), "trie-nodes")
    top = _skeleton_rows(found, skeleton)
    above = F.broadcast(top.select(F.col("skeleton").alias("parent"), F.col("conv_id").alias("least")))
    own = found.where(F.col("skeleton").isNull()).join(above, "parent", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "least"))
    return own.select(RESULT).unionByName(top.select(RESULT))


def _skeleton_rows(found: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Rows of the skeleton's nodes: partial counts are summed by node, then one pass from the deepest up."""
    spark = found.sparkSession
    parts = found.where(F.col("skeleton").isNotNull()).groupBy("skeleton").agg(
        F.min("conv_id"), *[F.sum(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends_sha256"))
    sums = {r[0]: [*r[1:]] for r in parts.collect()}
    # Numbers grow with depth along a path, so the children of a node come before it in this order.
    for node in sorted(sums, reverse=True):
        mine = sums[node]
        mine[3] += not mine[2]
        if node:
            mine[4] += (mine[1] - 1) * skeleton.last[node]
            above = sums[skeleton.parent[node]]
            above[2] += 1
            above[3] += mine[3]
            above[4] += mine[4]
    rows = [(node, None, s[0], skeleton.depth[node], sums[skeleton.parent[node]][0] if node else None, *s[1:5],
             s[5] or NONE_END) for node, s in sums.items()]
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(
        zip(*rows, strict=True) if rows else [()] * len(NODE), NODE, strict=True)], schema=NODE))
