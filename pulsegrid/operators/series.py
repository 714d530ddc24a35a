"""Ordered sample series per user-day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.catalogue import RAW_SERIES
from pulsegrid.functions import clock
from pulsegrid.functions.numbers import text_or_empty

DAY_SERIES = ["ID", "DATE", "SERIES"]
HEART_RATE_SERIES = "HEART_RATE_ARR"

# Samples per array. A longer day is continued in further rows, numbered by PART.
PART_ITEMS = 50_000


def raw_points(samples_df: DataFrame, series=RAW_SERIES) -> DataFrame:
    """Samples of the listed series as ID, DATE, SERIES, T, V; TIE tells equal T and V apart."""
    name = F.create_map(*[F.lit(x) for column, fact in series for x in (fact, column)])
    return samples_df.filter(
        F.col("METRIC").isin([f for _, f in series])
        & F.col("ID").isNotNull() & F.col("STARTTIME").isNotNull() & F.col("VALUE").isNotNull()
    ).select(
        "ID", clock.day(F.col("STARTTIME")).alias("DATE"),
        F.element_at(name, F.col("METRIC")).alias("SERIES"),
        F.col("STARTTIME").alias("T"), F.col("VALUE").alias("V"),
        F.xxhash64("ENDTIME", "UNIT", "UUID", "DEVICE").alias("TIE"),
    )


def heart_rate_points(samples_df: DataFrame) -> DataFrame:
    """Distinct heart rates per hour."""
    return (
        samples_df.filter((F.col("METRIC") == "HEARTRATE") & F.col("ID").isNotNull()
                          & F.col("STARTTIME").isNotNull())
        .select("ID", clock.day(F.col("STARTTIME")).alias("DATE"),
                clock.hour_start(F.col("STARTTIME")).alias("T"), F.col("VALUE").alias("V"))
        .distinct()
        .select("ID", "DATE", F.lit(HEART_RATE_SERIES).alias("SERIES"), "T", "V",
                F.xxhash64("V").alias("TIE"))
    )


def empty_hours(points: DataFrame) -> DataFrame:
    """A point without value for every hour a day with points has none in."""
    seen = points.groupBy(*DAY_SERIES).agg(F.collect_set("T").alias("SEEN"))
    hours = F.explode(F.array_except(clock.hours_of(F.col("DATE")), "SEEN"))
    return seen.select(*DAY_SERIES, hours.alias("T")).select(
        *DAY_SERIES, "T", F.lit(None).cast("double").alias("V"),
        F.lit(0).cast("bigint").alias("TIE"),
    )


def long_days(points: DataFrame, part_items: int = PART_ITEMS) -> DataFrame:
    """User-days (ID, DATE) with more than ``part_items`` points of one series."""
    sizes = points.groupBy(*DAY_SERIES).agg(F.count("*").alias("N"))
    return sizes.filter(F.col("N") > part_items).select("ID", "DATE").distinct()


def number_parts(points: DataFrame, part_items: int = PART_ITEMS) -> DataFrame:
    """Add PART, so that no (ID, DATE, SERIES, PART) holds many more than ``part_items`` points.

    A day is cut in time order: points are counted per second (at most 86,400 counts per day), the running
    count gives the part, and a second that spans parts is spread by TIE. Reading the parts in order
    gives the whole series.
    """
    points = points.withColumn("SECOND", clock.second_start(F.col("T")))
    so_far = Window.partitionBy(*DAY_SERIES).orderBy("SECOND").rowsBetween(
        Window.unboundedPreceding, -1
    )
    part_of = lambda n: F.floor(n / part_items).cast("int")
    before = F.coalesce(F.sum("N").over(so_far), F.lit(0))
    seconds = (
        points.groupBy(*DAY_SERIES, "SECOND").agg(F.count("*").alias("N"))
        .withColumn("BEFORE", before)
        .select(*DAY_SERIES, "SECOND", part_of(F.col("BEFORE")).alias("FIRST"),
                part_of(F.col("BEFORE") + F.col("N") - 1).alias("LAST"))
    )
    spread = F.pmod("TIE", (F.col("LAST") - F.col("FIRST") + 1).cast("bigint"))
    return points.join(seconds, [*DAY_SERIES, "SECOND"]).select(
        *DAY_SERIES, "T", "V", (F.col("FIRST") + spread).cast("int").alias("PART")
    )


def _collected(condition: Column) -> Column:
    """The points of a group in time order, equal times by value."""
    return F.sort_array(F.collect_list(F.when(condition, F.struct("T", "V"))))


def _shown(data: Column, value=lambda v: v) -> Column:
    """Array of DATE and val; NULL when it is empty."""
    element = lambda x: F.struct(x["T"].alias("DATE"), value(x["V"]).alias("val"))
    return F.when(F.size(data) > 0, F.transform(data, element))


def _with_empty_hours(data: Column) -> Column:
    """``empty_hours`` within an array that holds the whole day."""
    seen = F.transform(data, lambda x: x["T"])
    missing = F.array_except(clock.hours_of(F.col("DATE")), seen)
    point = lambda t: F.struct(t.alias("T"), F.lit(None).cast("double").alias("V"))
    return F.when(F.size(data) > 0, F.sort_array(F.concat(data, F.transform(missing, point))))


def _day_arrays(points: DataFrame, columns: list[str]) -> DataFrame:
    """Days that fit into one array each: grouped by user-day, as the joins that follow need it."""
    lists = points.groupBy("ID", "DATE").agg(
        *[_collected(F.col("SERIES") == c).alias(c) for c in columns]
    )
    return lists.withColumn("PART", F.lit(0))


def _part_arrays(points: DataFrame, columns: list[str], part_items: int) -> DataFrame:
    return number_parts(points, part_items).groupBy("ID", "DATE", "PART").agg(
        *[_collected(F.col("SERIES") == c).alias(c) for c in columns]
    )


def _arrays(points: DataFrame, columns: list[str], part_items: int, long: DataFrame | None) -> DataFrame:
    """One row per user-day, and one per part of the days named in ``long``.

    Both kinds are in every plan. Long days are few or none: the table of them is broadcast, and where it is
    empty their branch is gone before it starts.
    """
    long = (long_days(points, part_items) if long is None else long).select("ID", "DATE")
    hearted = HEART_RATE_SERIES in columns
    whole = _day_arrays(points.join(long, ["ID", "DATE"], "left_anti"), columns)
    cut = points.join(long, ["ID", "DATE"], "left_semi")
    if hearted:
        heart = F.col(HEART_RATE_SERIES)
        whole = whole.withColumn(HEART_RATE_SERIES, _with_empty_hours(heart))
        cut = cut.unionByName(empty_hours(cut.filter(F.col("SERIES") == HEART_RATE_SERIES)))
    return whole.unionByName(_part_arrays(cut, columns, part_items))


def day_series(samples_df: DataFrame, part_items: int = PART_ITEMS, long: DataFrame | None = None) -> DataFrame:
    """All six series of a user-day in one row per part. ``long`` may name the days with more than a part."""
    raw = [c for c, _ in RAW_SERIES]
    points = raw_points(samples_df).unionByName(heart_rate_points(samples_df))
    return _arrays(points, [HEART_RATE_SERIES, *raw], part_items, long).select(
        "ID", "DATE", "PART", _shown(F.col(HEART_RATE_SERIES), text_or_empty).alias(HEART_RATE_SERIES),
        *[_shown(F.col(c)).alias(c) for c in raw],
    )


def raw_series(samples_df: DataFrame, fact_name: str, part_items: int = PART_ITEMS) -> DataFrame:
    """ID, DATE, PART, DATA: the samples of one metric in time order."""
    rows = _arrays(raw_points(samples_df, (("DATA", fact_name),)), ["DATA"], part_items, None)
    return rows.select("ID", "DATE", "PART", _shown(F.col("DATA")).alias("DATA"))


def empty_heart_rate(date: Column) -> Column:
    return F.transform(
        clock.hours_of(date), lambda t: F.struct(t.alias("DATE"), F.lit("").alias("val"))
    )


def hourly_distinct(samples_df: DataFrame, spine: DataFrame,
                    part_items: int = PART_ITEMS) -> DataFrame:
    """Distinct heart rates per hour for every user-day of the spine, '' for empty hours."""
    name, points = HEART_RATE_SERIES, heart_rate_points(samples_df)
    rows = _arrays(points, [name], part_items, None)
    series = rows.select("ID", "DATE", "PART", _shown(F.col(name), text_or_empty).alias("DATA"))
    return spine.join(series, ["ID", "DATE"], "left").select(
        "ID", "DATE", F.coalesce("PART", F.lit(0)).alias("PART"),
        F.coalesce("DATA", empty_heart_rate(F.col("DATE"))).alias("DATA"),
    )
