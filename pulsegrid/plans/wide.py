"""The wide user-day table."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.catalogue import DAILY_SUMS, HOURLY_SUMS, POP_AGG_COLUMNS, RAW_SERIES
from pulsegrid.operators import history, population, rollup, series, sleep
from pulsegrid.operators.extract import sleep_fact
from pulsegrid.operators.sizing import WIDE_ROWS_PER_FILE
from pulsegrid.sources import tables
from pulsegrid.sources.dimensions import Calendar
from pulsegrid.sources.months import month_range, with_month

KEYS = ["ID", "DATE"]
_SUMS = [c for c, _ in DAILY_SUMS]
_SERIES = [series.HEART_RATE_SERIES, *[c for c, _ in RAW_SERIES]]
# Columns of a stored user-day, before profile, empty days and empty hours are filled in.
DAY_COLUMNS = [*KEYS, "PART", *_SUMS, "SLEEP", "HOURS", *_SERIES, "WEEK_CALS_ARR", "SLEEP_ARR"]


def samples_between(samples_df: DataFrame, calendar: Calendar,
                    history_days: int = history.HISTORY_DAYS) -> DataFrame:
    """Samples any calendar day can depend on: its history, its night from the evening before.

    Samples of documents without identifier belong to no user-day.
    """
    first = calendar.start - dt.timedelta(days=max(history_days - 1, 1))
    return samples_df.filter(
        F.col("ID").isNotNull() & F.col("DAY").between(F.lit(first), F.lit(calendar.last))
    )


def exceptional_days(samples_df: DataFrame, part_items: int = series.PART_ITEMS) -> DataFrame:
    """User-days that the usual plan does not cover: MIXED (a summed metric has several units) or LONG (a series
    has more samples than a part). Few or none; stored beside the samples, they are read again at no cost."""
    per_metric = rollup.units_per_day(samples_df).groupBy(*KEYS, "METRIC").agg(
        F.sum("N").alias("N"), F.count("*").alias("UNITS")
    )
    summed = F.col("METRIC").isin([f for _, f in DAILY_SUMS])
    listed = F.col("METRIC").isin("HEARTRATE", *[f for _, f in RAW_SERIES])
    return per_metric.groupBy(*KEYS).agg(
        F.bool_or(summed & (F.col("UNITS") > 1)).alias("MIXED"),
        F.bool_or(listed & (F.col("N") > part_items)).alias("LONG"),
    ).filter(F.col("MIXED") | F.col("LONG"))


def wide_days(samples_df: DataFrame, keys: DataFrame, calendar: Calendar,
              days: DataFrame | None = None, part_items: int = series.PART_ITEMS,
              history_days: int = history.HISTORY_DAYS, legacy_labels: bool = False,
              exceptional: DataFrame | None = None) -> DataFrame:
    """All user-day columns for the given keys (ID, DATE and whatever else they carry).

    Every input is aggregated to user-days before it is joined, by keys no busier than an hour, a
    minute or a part, so the joins meet one row per user-day. A day whose series is longer than a
    part has further rows, PART 1 and up, that carry only the rest of the series.

    A metric with several units on a day gives the day one row per unit. Both exceptions are part of the
    one plan; nothing is counted while it is made.

    ``days`` may hold ``rollup.user_days`` and ``exceptional`` the ``exceptional_days`` as stored tables.
    """
    rows = samples_between(samples_df, calendar, history_days)
    energy = history.daily_energy(rows) if days is None else history.energy_of_days(days)
    days = rollup.user_days(rows) if days is None else days
    week = history.energy_history(energy, calendar, history_days, legacy_labels)
    found = exceptional_days(rows, part_items) if exceptional is None else exceptional
    days = rollup.split_units(days, rows, found.filter("MIXED"))
    listed = series.day_series(rows, part_items, found.filter("LONG"))
    first_part = F.col("PART") == 0
    wide = (
        keys.join(days, KEYS, "left")
        .join(sleep.sleep_days(sleep_fact(rows)), KEYS, "left")
        .join(week.withColumnRenamed("DATA", "WEEK_CALS_ARR"), KEYS, "left")
        .join(listed, KEYS, "left")
        .withColumn("PART", F.coalesce("PART", F.lit(0)))
        .filter((F.col("PART") == 0) | (F.coalesce("VARIANT", F.lit(0)) == 0))
    )
    carried = [c for c in keys.columns if c not in KEYS]
    once = [*_SUMS, "SLEEP", "HOURS", "WEEK_CALS_ARR", "SLEEP_ARR"]
    return wide.withColumns({c: F.when(first_part, F.col(c)) for c in once}).select(
        *carried, *DAY_COLUMNS
    )


def fill_days(days: DataFrame, run_date: Column) -> DataFrame:
    """User-days with their profile to the published columns: empty hours and RUN_DATE filled."""
    first_part = F.col("PART") == 0
    heart = F.coalesce(
        series.HEART_RATE_SERIES, F.when(first_part, series.empty_heart_rate(F.col("DATE")))
    )
    once = {c: F.when(first_part, F.col(c)) for c, _ in HOURLY_SUMS}
    filled = rollup.fill_hours(days).withColumns(
        {**once, series.HEART_RATE_SERIES: heart, "RUN_DATE": run_date}
    )
    return filled.select(*POP_AGG_COLUMNS, "PART")


def pop_agg(samples_df: DataFrame, population_df: DataFrame, calendar: Calendar,
            run_date: Column | None = None, by_month: bool = False, **options) -> DataFrame:
    """One row per user and calendar day, 40 columns and PART.

    Sums, nights and arrays are NULL on days without samples, hourly arrays always have 24 entries.
    PART is 0 except on the continuation rows of very long days. ``by_month`` arranges the rows for
    ``store_pop_agg``, before the empty hours make them large, and adds MONTH: each task gets a slice of the users
    in one month, as many slices as the month's days need, in order of user and date. ``options`` go to ``wide_days``.
    """
    spine = population.profiled_spine(population_df, calendar)
    days = wide_days(samples_df, spine, calendar, **options)
    run_date = F.current_timestamp() if run_date is None else run_date
    if not by_month:
        return fill_days(days, run_date)
    first = calendar.start.replace(day=1)
    months = (calendar.last.year - first.year) * 12 + calendar.last.month - first.month + 1
    days_of = Counter((d.year - first.year) * 12 + d.month - first.month for d in calendar.listed())
    users = population_df.count()
    slices = [max(1, math.ceil(users * days_of[m] / WIDE_ROWS_PER_FILE)) for m in range(months)]
    before = list(accumulate(slices, initial=0))
    month = (F.year("DATE") - first.year) * 12 + F.month("DATE") - first.month
    of_month = lambda numbers: F.get(F.array(*[F.lit(n) for n in numbers]), month)
    task = of_month(before[:-1]) + F.pmod(F.xxhash64("ID"), of_month(slices)).cast("int")
    arranged = days.repartitionById(before[-1], task).sortWithinPartitions("ID", "DATE", "PART")
    return with_month(fill_days(arranged, run_date))


def store_pop_agg(rows: DataFrame, path: str) -> DataFrame:
    """Store the wide table by month. Within a month a user is in one file (``by_month``), sorted: a range of one
    user opens a file a month, and in it the row groups whose statistics and Bloom filter have the user."""
    rows.write.mode("overwrite").options(**tables.LOOKUP).partitionBy("MONTH").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def pop_agg_view(stored_days: DataFrame, population_df: DataFrame, calendar: Calendar,
                 run_date: Column | None = None) -> DataFrame:
    """The wide table over user-days kept by the incremental refresh."""
    spine = population.profiled_spine(population_df, calendar)
    days = month_range(stored_days, calendar.start, calendar.last).select(*DAY_COLUMNS)
    joined = spine.join(days, KEYS, "left").withColumn("PART", F.coalesce("PART", F.lit(0)))
    return fill_days(joined, F.current_timestamp() if run_date is None else run_date)
