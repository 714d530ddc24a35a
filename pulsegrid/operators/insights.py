"""Dashboard figures, for all users at once.

``trend`` rows are wide-table rows, one per user and day. The continuation rows of very long days (PART
above 0) hold series only and come where ``series`` asks for them.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import clock
from pulsegrid.functions.numbers import floor_div, half_even, nearest_int, truncate
from pulsegrid.sources.months import month_range

# Calories per pound of body mass; column and calories per gram of each macro-nutrient.
CALORIES_PER_POUND = 3500
MACROS = {"Protein": ("PROTEIN", 4), "Carbs": ("CARBS", 4), "Fat": ("FATTOTAL", 9)}


def trend(pop_agg: DataFrame, start, end, id: str | None = None, series: bool = False) -> DataFrame:
    """Wide-table rows of a date range (both ends included): of all users, or of one in order of date.

    Of a table that is parted by MONTH, the months of the range are read and no others.
    """
    rows = month_range(pop_agg, start, end).drop("MONTH")
    if not series:
        rows = rows.filter(F.col("PART") == 0)
    return rows if id is None else rows.filter(F.col("ID") == id).orderBy("DATE", "PART")


def kpis(trend_df: DataFrame) -> DataFrame:
    """Profile on the first day and averages over the range, one row per user."""
    burned = F.col("ACTIVE_ENERGY_BURNED") + F.col("BASAL_ENERGY_BURNED")
    first = lambda c: F.min_by(c, "DATE").alias(c)
    whole = lambda c, name: truncate(F.avg(c)).alias(name)
    return trend_df.groupBy("ID").agg(
        first("AGE"), first("GENDER"), first("BLOODTYPE"),
        whole("BODYMASS", "WEIGHT"),
        whole("STEPS", "STEPS"),
        whole("EXERCISE_TIME", "EXERCISE_MINS"),
        truncate(F.avg("APPLE_STAND_TIME") / 60).alias("STAND_MINS"),
        whole("FLIGHTSCLIMBED", "FLIGHTS"),
        whole("ACTIVE_ENERGY_BURNED", "ACTIVE_ENERGY"),
        whole("BASAL_ENERGY_BURNED", "BASAL_ENERGY"),
        truncate(F.avg(burned)).alias("CALS_BURNED"),
        whole("DIETARY_ENERGY", "CALS_CONSUMED"),
        half_even(F.avg("SLEEP") / 60, 2).alias("SLEEP_HOURS"),
    )


def nutrition_kpis(trend_df: DataFrame) -> DataFrame:
    return trend_df.groupBy("ID").agg(
        truncate(F.avg("CARBS")).alias("CARBS_G"),
        truncate(F.avg("PROTEIN")).alias("PROTEIN_G"),
        truncate(F.avg("FATTOTAL")).alias("FAT_G"),
        truncate(F.avg("SODIUM") * 1000).alias("SODIUM_MG"),
        truncate(F.avg("SUGAR")).alias("SUGAR_G"),
    )


def _macro(name: str) -> Column:
    column, per_gram = MACROS[name]
    return half_even(F.col(column)) * per_gram


def macro_calories(trend_df: DataFrame) -> DataFrame:
    """Calories per macro-nutrient and day, dated one day on as the chart shows them."""
    return trend_df.select(
        "ID", F.date_add("DATE", 1).alias("date"), *[_macro(n).alias(n) for n in MACROS]
    )


def burned_calories(trend_df: DataFrame) -> DataFrame:
    return trend_df.select(
        "ID", F.date_add("DATE", 1).alias("date"),
        half_even(F.col("BASAL_ENERGY_BURNED")).alias("Basal"),
        half_even(F.col("ACTIVE_ENERGY_BURNED")).alias("Active"),
    )


def melt(wide: DataFrame) -> DataFrame:
    """Every column but ID and date to variable and value."""
    columns = [c for c in wide.columns if c not in ("ID", "date")]
    return wide.unpivot(["ID", "date"], columns, "variable", "value")


def long_calories(wide: DataFrame) -> DataFrame:
    """Thousands per user, calendar day label and variable."""
    thousands = half_even(F.col("value") / 1000, 1)
    return melt(wide).groupBy("ID", clock.month_day(F.col("date")).alias("monthdate"), "variable").agg(
        F.sum(thousands).alias("value")
    )


def value_range(rows: DataFrame, column: str, *by: str) -> DataFrame:
    """Smallest and largest value: the domain of a chart axis."""
    return rows.groupBy(*by).agg(F.min(column).alias("LOW"), F.max(column).alias("HIGH"))


def chart_ceiling(trend_df: DataFrame) -> DataFrame:
    """Common upper end of the two calorie charts, in thousands."""
    burned = F.col("ACTIVE_ENERGY_BURNED") + F.col("BASAL_ENERGY_BURNED")
    eaten = reduce(lambda a, b: a + b, [_macro(n) for n in MACROS])
    return trend_df.groupBy("ID").agg(
        (F.greatest(F.max(burned), F.max(eaten)) / 1000).alias("CEILING")
    )


def calorie_balance(trend_df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Eaten minus burned calories, and the days it takes to gain or lose a pound.

    NULL where the range has no days or the balance per day is below one calorie.
    """
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    eaten = reduce(lambda a, b: a + b, [total(_macro(n)) for n in MACROS])
    burned = total(half_even(F.col("BASAL_ENERGY_BURNED"))) + total(
        half_even(F.col("ACTIVE_ENERGY_BURNED"))
    )
    sums = trend_df.groupBy("ID").agg((truncate(eaten) - truncate(burned)).alias("CAL_DIFF"))
    days = F.nullif(F.lit((end - start).days), F.lit(0))
    per_day = truncate(F.col("CAL_DIFF") / days)
    return sums.select(
        "ID", "CAL_DIFF",
        F.when(F.col("CAL_DIFF") < 0, "lose").otherwise("gain").alias("DIRECTION"),
        F.abs(floor_div(F.lit(CALORIES_PER_POUND), per_day)).alias("DAYS_PER_POUND"),
    )


def _between_midnights(start: dt.date, end: dt.date, include_end_day: bool) -> Column:
    """Times from the start date's midnight to the end date's; optionally all of the end date."""
    midnight = lambda d: F.lit(d).cast("timestamp_ntz")
    if include_end_day:
        return (F.col("STARTTIME") >= midnight(start)) & (
            F.col("STARTTIME") < midnight(end + dt.timedelta(days=1))
        )
    return F.col("STARTTIME").between(midnight(start), midnight(end))


def heart_kpis(samples_df: DataFrame, start: dt.date, end: dt.date,
               include_end_day: bool = False) -> DataFrame:
    """Average heart figures per user as whole numbers, from one pass over four metrics."""
    facts = {"HEARTRATE": 1, "RESTINGHEARTRATE": 60, "WALKINGHEARTAVG": 60, "HEARTRATESDNN": 1}
    names = ("HEART_RATE", "RESTING_HR", "WALKING_HR", "HR_SDNN")
    mean = lambda f: F.avg(F.when(F.col("METRIC") == f, F.col("VALUE")))
    in_range = (
        F.col("METRIC").isin(list(facts))
        & F.col("DAY").between(F.lit(start), F.lit(end))
        & _between_midnights(start, end, include_end_day)
    )
    return samples_df.filter(in_range).groupBy("ID").agg(
        *[nearest_int(mean(f) * k).alias(n) for (f, k), n in zip(facts.items(), names)]
    )


def heart_points(heart_rate: DataFrame, start: dt.date, end: dt.date,
                 include_end_day: bool = False) -> DataFrame:
    """Distinct whole heart rates per day, dated one day on as the chart shows them."""
    return (
        heart_rate.filter(_between_midnights(start, end, include_end_day))
        .select("ID", F.date_add(clock.day(F.col("STARTTIME")), 1).alias("DATE"),
                nearest_int(F.col("VALUE")).alias("HR"))
        .distinct()
    )


def meal_calories(dietary_energy: DataFrame) -> DataFrame:
    """Calories per user, day and time of day."""
    start = F.col("STARTTIME")
    return (
        dietary_energy.filter(F.col("VALUE") > 0)
        .groupBy("ID", clock.day(start).alias("DATE"), clock.time_of_day(start).alias("TIME"))
        .agg(F.sum("VALUE"))
        .toDF("ID", "DATE", "TIME", "CALS")
    )


def latest_sample(samples_df: DataFrame, until=None) -> DataFrame:
    """The most recent sample per user and metric that has ended by ``until``.

    A maximum, not a sort: each task keeps one sample per user and metric.
    """
    fields = ("STARTTIME", "ENDTIME", "VALUE", "UNIT", "UUID", "DEVICE")
    rows = samples_df.filter(F.col("STARTTIME").isNotNull())
    if until is not None:
        rows = rows.filter(F.col("ENDTIME") <= F.lit(until).cast("timestamp_ntz"))
    last = rows.groupBy("ID", "METRIC").agg(F.max(F.struct(*fields)).alias("L"))
    return last.select("ID", "METRIC", *[F.col(f"L.{f}").alias(f) for f in fields])


def day_total(samples_df: DataFrame, fact_name: str, as_of) -> DataFrame:
    """Total of one metric from midnight to ``as_of`` (a time, or a date for the whole day)."""
    if isinstance(as_of, dt.datetime):
        until = F.col("STARTTIME") <= F.lit(as_of).cast("timestamp_ntz")
        date = as_of.date()
    else:
        until, date = F.lit(True), as_of
    return (
        samples_df.filter((F.col("METRIC") == fact_name) & (F.col("DAY") == F.lit(date)) & until)
        .groupBy("ID").agg(F.sum("VALUE").alias("VALUE"))
    )
