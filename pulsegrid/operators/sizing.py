"""Plan choices that rest on a count."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Key rows that may be broadcast; 200,000 of them take some tens of megabytes.
BROADCAST_ROWS = 200_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; counting stops there."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint when the count allows it; otherwise the join is left to shuffle."""
    return F.broadcast(df) if is_small(df, rows) else df


# Rows a task should make when a small table is multiplied, and rows of the wide table per file. A wide row is some 50
# bytes in its file, but its arrays hold 200 values or more, each of which is written and read one by one.
ROWS_PER_TASK = 2_000_000
WIDE_ROWS_PER_FILE = 100_000

# HotSpot interprets methods of more than 8,000 bytes for good, and plans of the wide table make such methods.
_METHOD_SETTING, _METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


def compiled_methods(spark: SparkSession) -> None:
    """Have stages whose generated method would never be compiled run operator by operator, whose methods are small,
    unless the session has a limit of its own."""
    if spark.conf.get(_METHOD_SETTING, None) is None:
        spark.conf.set(_METHOD_SETTING, str(_METHOD_BYTES))


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / rows_per_task))


def spread(df: DataFrame, rows_each: int, *keys: str) -> DataFrame:
    """Partition a small table by what it grows to, before each row becomes ``rows_each`` rows.

    Users fit into a few files, their days do not: without this a handful of tasks would write
    all of them.
    """
    return df.repartition(tasks_for(df.sparkSession, df.count() * rows_each), *keys)
