"""Bounded samples of a table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 32


def drawn(rows: DataFrame, limit: int, *by: str) -> DataFrame:
    """At most `limit` rows, those whose `by` columns hash lowest; the same rows on every run.

    A share of the hash range that holds a little more than `limit` rows is cut out first, so tasks pass on about as
    many rows as are wanted, however many tasks there are. Rows that agree in all `by` columns are drawn or left
    together until the limit cuts them; a table of few distinct ones may give fewer rows.
    """
    order = F.xxhash64(*by)
    total = rows.count()
    if total > limit:
        share = (limit + 10 * math.sqrt(limit) + 100) / total
        rows = rows.where(F.pmod(order, F.lit(_RANGE)) < int(min(1.0, share) * _RANGE))
    return rows.withColumn("__order", F.pmod(order, F.lit(_RANGE))).orderBy("__order", *by).limit(limit).drop("__order")
