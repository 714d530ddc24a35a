"""Nights: totals, stage segments, hour-by-hour layout, minute strip."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.catalogue import ASLEEP_STAGES, HOURLY_CYCLES
from pulsegrid.functions import clock

# A night belongs to the day it is in six hours after its start: the day turns at 18:00.
NIGHT_SHIFT = 6
NIGHT = ["ID", "DATE"]
# Minutes a segment is unfolded by at a time.
STRIP_CHUNK = 1440


def _shifted(ts="STARTTIME"):
    return clock.shift_hours(F.col(ts), NIGHT_SHIFT)


def sleep_nightly(sleep: DataFrame) -> DataFrame:
    """Minutes asleep per night."""
    return (
        sleep.filter(F.col("VALUE").isin(*ASLEEP_STAGES))
        .groupBy("ID", clock.day(_shifted()).alias("DATE"))
        .agg(F.sum("MINS").alias("SLEEP"))
    )


def segment_minutes(sleep: DataFrame) -> DataFrame:
    """Minutes per starting minute and stage, everything but time in bed.

    At most one row per minute and stage is left of a night, however often it was recorded.
    """
    return (
        sleep.filter((F.col("VALUE") != 0) & F.col("STARTTIME").isNotNull())
        .groupBy("ID", clock.minute_start(F.col("STARTTIME")).alias("T"), "CYCLE", "VALUE")
        .agg(F.sum("MINS").alias("MINS"))
        .withColumn("DATE", clock.day(_shifted("T")))
    )


def _segment_array():
    complete = F.col("CYCLE").isNotNull() & F.col("MINS").isNotNull() & F.col("T").isNotNull()
    segment = F.struct(
        F.col("T").alias("DATE"), F.col("MINS").cast("double").alias("val"),
        F.col("CYCLE").alias("cycle"),
    )
    ordered = F.sort_array(F.collect_list(F.when(complete, F.struct("T", "CYCLE", segment.alias("S")))))
    return F.transform(ordered, lambda x: x["S"])


def sleep_days(sleep: DataFrame) -> DataFrame:
    """SLEEP (minutes asleep) and SLEEP_ARR (ordered segments) per night, from one grouping."""
    asleep = F.sum(F.when(F.col("VALUE").isin(*ASLEEP_STAGES), F.col("MINS")))
    return segment_minutes(sleep).groupBy(*NIGHT).agg(
        asleep.alias("SLEEP"), _segment_array().alias("SLEEP_ARR")
    )


def sleep_segments(sleep: DataFrame) -> DataFrame:
    return segment_minutes(sleep).groupBy(*NIGHT).agg(_segment_array().alias("DATA"))


def normalise_sleep(nights: DataFrame, data: str = "DATA", keep_tail: bool = False) -> DataFrame:
    """Lay each night's segments end to end and count minutes per clock hour and stage.

    Gaps between segments are closed, and stages outside the four counted ones take up time
    without being counted. There are as many hours as the night has started hours of sleep, from
    the hour of its first segment; minutes beyond the last one are dropped unless ``keep_tail``.
    A night without segments gives NULL. At most 24 x 60 starting minutes of few stages make a
    night, so its rows are sorted in one small group.
    """
    rows = nights.select(*NIGHT, F.posexplode_outer(data).alias("POS", "SEG"))
    minutes = F.greatest(F.coalesce(F.col("SEG.val").cast("bigint"), F.lit(0)), F.lit(0))
    night = Window.partitionBy(*NIGHT)
    earlier = night.orderBy("POS").rowsBetween(Window.unboundedPreceding, -1)
    laid = (
        rows.select(*NIGHT, "POS", F.col("SEG.DATE").alias("T"), F.col("SEG.cycle").alias("CYCLE"),
                    minutes.alias("V"))
        .withColumn("START", F.min_by("T", "POS").over(night))
        .withColumn("TOTAL", F.sum("V").over(night))
        .withColumn("FROM", F.minute("START") + F.coalesce(F.sum("V").over(earlier), F.lit(0)))
        .withColumn("TO", F.col("FROM") + F.col("V"))
    )
    length = F.minute("START") + F.col("TOTAL") if keep_tail else F.col("TOTAL")
    last = F.least(F.ceil(length / 60) - 1, F.floor((F.col("TO") - 1) / 60))
    first = F.floor(F.col("FROM") / 60)
    hours = F.when((F.col("V") > 0) & (first <= last), F.sequence(first, last))
    spread = laid.select(*NIGHT, "POS", "START", "CYCLE", "FROM", "TO",
                         F.explode_outer(hours).alias("HOUR"))
    overlap = F.least("TO", F.col("HOUR") * 60 + 60) - F.greatest("FROM", F.col("HOUR") * 60)
    per_hour = spread.groupBy(*NIGHT, "HOUR").agg(
        F.min("START").alias("START"),
        F.max("POS").alias("POS"),
        *[
            F.coalesce(F.sum(F.when(F.col("CYCLE") == c, overlap)), F.lit(0)).alias(c)
            for c in HOURLY_CYCLES
        ],
    )
    clock_hour = clock.hour_start(F.col("START")) + F.make_dt_interval(
        F.lit(0), F.col("HOUR").cast("int")
    )
    cells = F.array(*[
        F.struct(clock_hour.alias("DATE"), F.lit(c).alias("cycle"), F.col(c).alias("val"))
        for c in HOURLY_CYCLES
    ])
    collected = F.sort_array(
        F.collect_list(F.when(F.col("HOUR").isNotNull(), F.struct(F.col("HOUR"), cells.alias("C"))))
    )
    return per_hour.groupBy(*NIGHT).agg(
        F.when(F.max("POS").isNotNull(), F.flatten(F.transform(collected, lambda x: x["C"])))
        .alias("DATA")
    )


def sleep_timeline(sleep: DataFrame, start, end) -> DataFrame:
    """Minutes per starting minute and stage for the nights in a date range."""
    night = clock.day(_shifted())
    return (
        sleep.filter((F.col("VALUE") != 0) & night.between(F.lit(start), F.lit(end)))
        .groupBy("ID", clock.minute_start(F.col("STARTTIME")).alias("STARTTIME"), "CYCLE",
                 night.alias("DAY"))
        .agg(F.sum("MINS").alias("SLEEP"))
        .select("ID", "STARTTIME", "SLEEP", "CYCLE", "DAY")
    )


def sleep_strip(timeline: DataFrame) -> DataFrame:
    """One row per minute of sleep, numbered from 1 within each night."""
    minutes = F.greatest(F.coalesce("SLEEP", F.lit(0)), F.lit(0))
    earlier = (
        Window.partitionBy("ID", "DAY").orderBy("STARTTIME", "CYCLE")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum(minutes).over(earlier), F.lit(0))
    chunks = F.sequence(F.lit(0), F.floor((F.col("SLEEP") - 1) / STRIP_CHUNK))
    low = F.col("CHUNK") * STRIP_CHUNK + 1
    high = F.least(low + STRIP_CHUNK - 1, F.col("SLEEP"))
    return (
        timeline.withColumn("OFFSET", offset)
        .filter(F.col("SLEEP") > 0)
        .select("ID", "DAY", "CYCLE", "OFFSET", "SLEEP", F.explode(chunks).alias("CHUNK"))
        .select("ID", "DAY", "CYCLE", "OFFSET", F.explode(F.sequence(low, high)).alias("MINUTE"))
        .select("ID", (F.col("OFFSET") + F.col("MINUTE")).alias("X"), F.col("DAY").alias("Y"),
                F.col("CYCLE").alias("Cat"))
    )
