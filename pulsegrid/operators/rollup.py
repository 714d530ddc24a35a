"""Daily and hourly totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.catalogue import DAILY_SUMS, HOURLY_SUMS
from pulsegrid.functions import clock
from pulsegrid.operators.extract import fact

KEYS = ["ID", "DATE"]
_SUMMED_FACTS = [f for _, f in DAILY_SUMS]
_HOURLY_FACTS = [f for _, f in HOURLY_SUMS]
_COLUMN_OF = {f: c for c, f in DAILY_SUMS}


def _date() -> Column:
    """The day of a sample, from its time and not from the partition column.

    The partitions to read are chosen by an explicit range; a join on the partition column would
    make Spark plan a second, dynamic choice.
    """
    return clock.day(F.col("STARTTIME")).alias("DATE")


def daily_sum(fact_df: DataFrame) -> DataFrame:
    return fact_df.groupBy("ID", _date(), "UNIT").agg(
        F.sum("VALUE").alias("VALUE")
    )


def hourly_sum(fact_df: DataFrame) -> DataFrame:
    return fact_df.groupBy("ID", clock.hour_start(F.col("STARTTIME")).alias("DATE")).agg(
        F.sum("VALUE").alias("VALUE")
    )


def _sum_of(fact_name: str, total=F.sum) -> Column:
    return total(F.when(F.col("METRIC") == fact_name, F.col("VALUE")))


def daily_totals(samples_df: DataFrame, averaged: tuple[str, ...] = ()) -> DataFrame:
    """One row per active user-day with the 18 sums side by side, from one grouping.

    Columns named in ``averaged`` (body mass, say) hold the mean of the day instead.
    """
    total = lambda c: F.avg if c in averaged else F.sum
    return (
        samples_df.filter(F.col("METRIC").isin(_SUMMED_FACTS))
        .groupBy("ID", _date())
        .agg(*[_sum_of(f, total(c)).alias(c) for c, f in DAILY_SUMS])
    )


def user_days(samples_df: DataFrame) -> DataFrame:
    """Active user-days: the 18 sums, and HOURS, a map from hour to that hour's sums.

    Samples are first summed per user-hour, which is where a busy user or day is spread out and
    combined before the shuffle. The day grouping then meets at most 24 rows per user-day.
    """
    hours = (
        samples_df.filter(F.col("METRIC").isin(_SUMMED_FACTS))
        .groupBy("ID", _date(), F.hour("STARTTIME").alias("HOUR"))
        .agg(*[_sum_of(f).alias(c) for c, f in DAILY_SUMS])
    )
    hour_sums = F.struct("HOUR", F.struct(*[F.col(_COLUMN_OF[f]).alias(f) for f in _HOURLY_FACTS]))
    return hours.groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c, _ in DAILY_SUMS],
        F.map_from_entries(F.collect_list(hour_sums)).alias("HOURS"),
    )


def fill_hours(rows: DataFrame) -> DataFrame:
    """HOURS to one 24-entry array per hourly metric, with 0 where an hour has no samples.

    Works row by row, so empty user-days cost no join with an hour spine. The array of zeros is
    made once per row and shared by the metrics without samples, which on most rows is all of them.
    """
    zero = lambda t: F.struct(t.alias("DATE"), F.lit(0.0).alias("val"))

    def series(fact_name: str) -> Column:
        sums = lambda hour: F.try_element_at("HOURS", hour)[fact_name]
        filled = lambda t, hour: F.struct(
            t.alias("DATE"), F.coalesce(sums(hour), F.lit(0.0)).alias("val")
        )
        return F.when(F.col(_COLUMN_OF[fact_name]).isNull(), F.col("ZEROS")).otherwise(
            F.transform("STARTS", filled)
        )

    return (
        rows.withColumn("STARTS", clock.hours_of(F.col("DATE")))
        .withColumn("ZEROS", F.transform("STARTS", zero))
        .withColumns({c: series(f) for c, f in HOURLY_SUMS})
        .drop("STARTS", "ZEROS", "HOURS")
    )


def hourly_series(fact_df: DataFrame, spine: DataFrame) -> DataFrame:
    """Zero-filled hourly sums of one metric as an ordered array for every user-day."""
    by_day = hourly_sum(fact_df).groupBy("ID", clock.day(F.col("DATE")).alias("DATE")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.hour("DATE"), "VALUE"))).alias("HOURS")
    )
    filled = lambda t, hour: F.struct(
        t.alias("DATE"), F.coalesce(F.try_element_at("HOURS", hour), F.lit(0.0)).alias("val")
    )
    return spine.join(by_day, KEYS, "left").select(
        *KEYS, F.transform(clock.hours_of(F.col("DATE")), filled).alias("DATA")
    )


def hourly_fill(fact_df: DataFrame, hour_spine: DataFrame) -> DataFrame:
    """Zero-filled hourly sums, one row per user-hour of the spine."""
    sums = hourly_sum(fact_df)
    return hour_spine.join(sums, KEYS, "left").select(
        *KEYS, F.coalesce("VALUE", F.lit(0.0)).alias("VALUE")
    )


def units_per_day(samples_df: DataFrame) -> DataFrame:
    """Samples per user, day, metric and unit, counted before they are shuffled."""
    return samples_df.groupBy("ID", _date(), "METRIC", "UNIT").agg(F.count("*").alias("N"))


def mixed_units(samples_df: DataFrame) -> DataFrame:
    """User-days on which a summed metric arrives in more than one unit."""
    unit = F.coalesce(F.col("UNIT"), F.lit(""))
    return (
        units_per_day(samples_df.filter(F.col("METRIC").isin(_SUMMED_FACTS)))
        .groupBy("ID", "DATE", "METRIC")
        .agg(F.min(unit).alias("FIRST_UNIT"), F.max(unit).alias("LAST_UNIT"),
             F.count("*").alias("UNITS"))
        .filter(F.col("UNITS") > 1)
        .drop("UNITS")
    )


def daily_wide(samples_df: DataFrame, spine: DataFrame,
               averaged: tuple[str, ...] = ()) -> DataFrame:
    """The 18 daily sums beside every spine day: one grouping and one join.

    Sums run over all units of a metric; ``daily_wide_joins`` keeps units apart.
    """
    return spine.join(daily_totals(samples_df, averaged), KEYS, "left").select(
        *KEYS, *[c for c, _ in DAILY_SUMS]
    )


def daily_wide_joins(samples_df: DataFrame, spine: DataFrame) -> DataFrame:
    """The same table by one left join per metric; several units on a day give several rows."""
    wide = spine
    for column, fact_name in DAILY_SUMS:
        sums = daily_sum(fact(samples_df, fact_name)).select(*KEYS, F.col("VALUE").alias(column))
        wide = wide.join(sums, KEYS, "left")
    return wide


def split_units(days: DataFrame, samples_df: DataFrame, mixed: DataFrame) -> DataFrame:
    """``user_days`` with one row per combination of units where a metric has several on a day.

    ``mixed`` names the user-days (ID, DATE) where that may be so. Only these are summed again, unit by unit.
    VARIANT numbers the rows of a day from 0. A day with many units makes many rows; half of the
    metrics are multiplied out first, then the rows are dealt anew, so that no task makes all of them.
    """
    dated = samples_df.filter(F.col("METRIC").isin(_SUMMED_FACTS)).withColumn("DATE", _date())
    per_unit = dated.join(mixed.select(*KEYS), KEYS, "left_semi").groupBy(*KEYS, "METRIC", "UNIT").agg(
        F.sum("VALUE").alias("VALUE"))
    sums = [c for c, _ in DAILY_SUMS]
    listed = lambda f: F.collect_list(F.when(F.col("METRIC") == f, F.struct("VALUE")))
    rows = per_unit.groupBy(*KEYS).agg(
        *[F.sort_array(F.array_distinct(listed(f))).alias(c) for c, f in DAILY_SUMS]
    ).withColumn("VARIANT", F.lit(0).cast("bigint"))
    for i, c in enumerate(sums):  # a row per unit, one metric after the other; nothing is joined or read again
        if i == len(sums) // 2:
            rows = rows.hint("rebalance")
        kept = [x for x in rows.columns if x not in (c, "VARIANT")]
        number = F.col("VARIANT") * F.greatest(F.size(c), F.lit(1)) + F.coalesce("AT", F.lit(0))
        rows = rows.select("*", F.posexplode_outer(c).alias("AT", "E")).select(
            *kept, F.col("E.VALUE").alias(c), number.alias("VARIANT"))
    by_unit = rows.join(days.select(*KEYS, "HOURS"), KEYS)
    single = days.join(mixed.select(*KEYS), KEYS, "left_anti").withColumn("VARIANT", F.lit(0).cast("bigint"))
    return single.unionByName(by_unit)
