"""Who is known, and the user-day and user-hour spines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import clock
from pulsegrid.operators.sizing import spread
from pulsegrid.sources.dimensions import DEFAULT_CALENDAR, Calendar

PROFILE = ("ID", "AGE", "BLOODTYPE", "GENDER", "LOADTIME")


def population(documents: DataFrame) -> DataFrame:
    """Profiles of each user's latest upload; equally late, different profiles are all kept.

    Uploads are first merged per user and load time, so a user with very many uploads is spread
    out, and each task then passes on one load time per user. Documents are read once; a filter on ID would parse
    each once more, so uploads without one are merged into a group that holds no profile.
    """
    named = F.col("ID").isNotNull()
    profile = F.when(named, F.struct("AGE", "BLOODTYPE", "GENDER"))
    uploads = (
        documents.groupBy("ID", F.when(named, F.col("LOADTIME")).alias("LOADTIME"))
        .agg(F.collect_set(profile).alias("P"))
    )
    latest = uploads.groupBy("ID").agg(
        F.max_by("P", "LOADTIME").alias("P"), F.max("LOADTIME").alias("LOADTIME")
    )
    return latest.select("ID", F.inline("P"), "LOADTIME").select(*PROFILE)


def users(population_df: DataFrame) -> DataFrame:
    return population_df.select("ID").distinct()


def day_spine(population_df: DataFrame, calendar: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """Every user on every day. The days are generated in place, per user row: no join."""
    ids = spread(users(population_df), calendar.days, "ID")
    return ids.select("ID", F.explode(calendar.dates()).alias("DATE"))


def hour_spine(population_df: DataFrame, calendar: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    hours = F.sequence(F.lit(0), F.lit(23))
    ids = spread(users(population_df), calendar.days * 24, "ID")
    return (
        ids.select("ID", F.explode(calendar.dates()).alias("DATE"))
        .select("ID", "DATE", F.explode(hours).alias("H"))
        .select("ID", clock.at_hour(F.col("DATE"), F.col("H")).alias("DATE"))
    )


def profiled_spine(population_df: DataFrame, calendar: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """The day spine with profile columns carried along instead of joined afterwards."""
    profiles = spread(population_df.select("ID", "AGE", "BLOODTYPE", "GENDER"), calendar.days, "ID")
    return profiles.select("*", F.explode(calendar.dates()).alias("DATE"))
