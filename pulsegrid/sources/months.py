"""Tables parted by the month of DATE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_month(rows: DataFrame) -> DataFrame:
    """Adds MONTH, the first day of the month of DATE, which stored wide tables are parted by."""
    return rows.withColumn("MONTH", F.trunc("DATE", "month"))


def month_range(rows: DataFrame, start, end) -> DataFrame:
    """Rows of a date range; of a table that is parted by month, only the months that it needs."""
    within = F.col("DATE").between(F.lit(start), F.lit(end))
    if "MONTH" in rows.columns:
        month = lambda d: F.trunc(F.lit(d).cast("date"), "month")
        within = F.col("MONTH").between(month(start), month(end)) & within
    return rows.filter(within)
