"""Calendar dimensions generated by row number."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Calendar(NamedTuple):
    """A run of days: the range of dimensions and spines."""

    start: dt.date
    days: int

    @property
    def last(self) -> dt.date:
        return self.start + dt.timedelta(days=self.days - 1)

    def listed(self) -> list[dt.date]:
        return [self.start + dt.timedelta(days=n) for n in range(self.days)]

    def dates(self) -> Column:
        return F.sequence(F.lit(self.start), F.lit(self.last), F.expr("interval 1 day"))

    def contains(self, date: Column) -> Column:
        return date.between(F.lit(self.start), F.lit(self.last))


# Five years of 366 days, and the older, longer range.
DEFAULT_CALENDAR = Calendar(dt.date(2020, 1, 1), 366 * 5)
LONG_CALENDAR = Calendar(dt.date(2015, 1, 1), 10000)


def _year_to_month(date: Column) -> list[Column]:
    return [
        F.year(date).cast("smallint").alias("YEAR"),
        F.month(date).cast("smallint").alias("MONTH"),
        F.date_format(date, "MMM").alias("MONTH_NAME"),
        F.dayofmonth(date).cast("smallint").alias("DAY_OF_MON"),
    ]


def _week_and_year(date: Column) -> list[Column]:
    return [
        F.dayofweek(date).cast("string").alias("DAY_OF_WEEK"),
        F.weekofyear(date).cast("smallint").alias("WEEK_OF_YEAR"),
        F.dayofyear(date).cast("smallint").alias("DAY_OF_YEAR"),
    ]


def date_dim(spark: SparkSession, calendar: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    date = F.date_add(F.lit(calendar.start), F.col("id").cast("int"))
    rows = spark.range(calendar.days).select(date.alias("DATE"))
    return rows.select("DATE", *_year_to_month(F.col("DATE")), *_week_and_year(F.col("DATE")))


def hour_dim(spark: SparkSession, calendar: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    first = F.lit(calendar.start).cast("timestamp_ntz")
    rows = spark.range(calendar.days * 24).select(
        (first + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("DATE")
    )
    hour = F.hour("DATE").cast("smallint").alias("HOUR")
    return rows.select("DATE", *_year_to_month(F.col("DATE")), hour, *_week_and_year(F.col("DATE")))
