"""Weighted rendezvous hashing of records into shards.

Law `key`: the key and the set of shards decide, nothing else. Every shard bids for a key with
-weight / ln(u), u drawn in (0, 1) from a hash of key and shard; the highest bid wins. A new shard leaves all
other bids as they were, so rows move only into it, and a share of rows in proportion to its weight.

Defined results: a null key bids as the empty text; a null text has size 1 and the checksum of no bytes; rows
that repeat a key share its shard and take slots of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.storage import stored

#: Parts of a shard that are numbered side by side. Slots of a part are ordered by key within it.
PARTS = 512
#: Slots of one repeated record that are written out together.
RUN = 100_000


def _unit(digest: Column) -> Column:
    """52 bits of a hexadecimal digest as a number in (0, 1)."""
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def bid(key: Column, shard: int, weight: float) -> Column:
    return -F.lit(float(weight)) / F.log(_unit(F.md5(F.concat(key, F.lit(f":{shard}")))))


def winner(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard with the highest bid; equal bids go to the lower number."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    bids = F.array(*(bid(key, i, w) for i, w in enumerate(weights)))
    return (F.array_position(bids, F.array_max(bids)) - 1).cast("int")


def shard_records(records: DataFrame, key: str, text: str, weights: Sequence[float],
                  new_weight: float | None = None, parts: int = PARTS) -> DataFrame:
    """Columns key, size, text_crc32, shard, slot, and grown_shard: the shard after one more of `new_weight` joins.

    Slots of a shard are 0, 1, ... without gaps. Equal records (key, size, checksum) are counted in each task before
    they move and take neighbouring slots. A shard is numbered in `parts` parts by a hash of the whole record: records are
    counted by part (shards x parts sums, whatever the input), the starts of the parts added up, and records numbered in each
    part, so no shard, key or repeated record is sorted by one task.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    new_weight = weights[0] if new_weight is None else new_weight
    bids_of = lambda name: F.array(*(bid(name, i, w) for i, w in enumerate([*weights, new_weight])))
    rows = records.select(
        F.col(key).alias("key"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    ).groupBy("key", "size", "text_crc32").agg(F.count("*").alias("times"))
    rows = stored(rows.withColumn("bids", bids_of(F.coalesce(F.col("key").cast("string"), F.lit("")))).withColumn(
        "old", F.slice("bids", 1, len(weights))).select(
        "key", "size", "text_crc32", "times",
        F.pmod(F.xxhash64("key", "size", "text_crc32"), F.lit(parts)).cast("int").alias("part"),
        (F.array_position("old", F.array_max("old")) - 1).cast("int").alias("shard"),
        (F.array_position("bids", F.array_max("bids")) - 1).cast("int").alias("grown_shard"),
    ), "shards")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "part").agg(F.sum("times").alias("count")).select(
        "shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("shard", "part").orderBy("key", "size", "text_crc32").rowsBetween(
        Window.unboundedPreceding, -1)
    first = rows.join(F.broadcast(starts), ["shard", "part"]).withColumn(
        "first", F.col("start") + F.coalesce(F.sum("times").over(within), F.lit(0)))
    # A record that very many rows repeat is dealt to the tasks in runs of slots.
    runs = first.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / RUN))))
    runs = runs.withColumn("low", F.col("first") + F.col("run") * RUN).withColumn(
        "high", F.least(F.col("low") + RUN, F.col("first") + F.col("times")) - 1)
    return runs.hint("rebalance").select(
        "key", "size", "text_crc32", "shard", F.explode(F.sequence("low", "high")).alias("slot"), "grown_shard",
    )
