"""Daily energy and its trailing history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions import clock

HISTORY_DAYS = 10

_ENERGY_FACTS = {
    "CONSUMED": "DIETARYENERGY",
    "ACTIVE_ENERGY": "ACTIVE_ENERGY_BURNED",
    "BASAL_ENERGY": "BASALENERGYBURNED",
}
_ENERGY_COLUMNS = {
    "CONSUMED": "DIETARY_ENERGY",
    "ACTIVE_ENERGY": "ACTIVE_ENERGY_BURNED",
    "BASAL_ENERGY": "BASAL_ENERGY_BURNED",
}


def daily_energy(samples_df: DataFrame) -> DataFrame:
    """Energy in and out per day; a kind without samples on an active day counts as 0."""
    total = lambda f: F.sum(F.when(F.col("METRIC") == f, F.col("VALUE")))
    return (
        samples_df.filter(F.col("METRIC").isin(list(_ENERGY_FACTS.values())))
        .groupBy("ID", clock.day(F.col("STARTTIME")).alias("TIME"))
        .agg(*[F.coalesce(total(f), F.lit(0.0)).alias(c) for c, f in _ENERGY_FACTS.items()])
    )


def energy_of_days(user_days: DataFrame) -> DataFrame:
    """The same table taken from user-day totals already computed."""
    any_energy = F.coalesce(*_ENERGY_COLUMNS.values()).isNotNull()
    return user_days.filter(any_energy).select(
        "ID", F.col("DATE").alias("TIME"),
        *[F.coalesce(F.col(src), F.lit(0.0)).alias(c) for c, src in _ENERGY_COLUMNS.items()],
    )


def _entry(legacy_labels: bool):
    """Array element; the older labels name each kind after another one."""
    active, basal, consumed = (
        ("CONSUMED", "ACTIVE_ENERGY", "BASAL_ENERGY") if legacy_labels
        else ("ACTIVE_ENERGY", "BASAL_ENERGY", "CONSUMED")
    )
    entry = F.struct(
        F.col("TIME").cast("timestamp_ntz").alias("DATE"), F.col(active).alias("ACTIVE"),
        F.col(basal).alias("BASAL"), F.col(consumed).alias("CONSUMED"),
    )
    complete = F.lit(True)
    for c in ("TIME", "CONSUMED", "ACTIVE_ENERGY", "BASAL_ENERGY"):
        complete = complete & F.col(c).isNotNull()
    return F.when(complete, entry)


def energy_history(energy: DataFrame, calendar, days: int = HISTORY_DAYS,
                   legacy_labels: bool = False) -> DataFrame:
    """The last ``days`` days of energy for every day that has any, as an ordered array.

    Each day of energy is sent forward to the days that look back on it, which makes the range
    condition an equality on (ID, DATE): at most ``days`` rows meet in a group.
    """
    served = energy.filter(
        F.col("TIME").between(F.date_sub(F.lit(calendar.start), days - 1), F.lit(calendar.last))
    ).withColumn("AHEAD", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
    return (
        served.withColumn("DATE", F.date_add("TIME", F.col("AHEAD")))
        .filter(calendar.contains(F.col("DATE")))
        .groupBy("ID", "DATE")
        .agg(F.sort_array(F.collect_list(_entry(legacy_labels))).alias("DATA"))
    )


def energy_history_window(energy: DataFrame, spine: DataFrame, days: int = HISTORY_DAYS,
                          legacy_labels: bool = False) -> DataFrame:
    """The same by a range frame over the spine days of a user (one row per day)."""
    rows = (
        spine.withColumn("IN_SPINE", F.lit(True))
        .join(energy.withColumn("DATE", F.col("TIME")), ["ID", "DATE"], "full")
        .withColumn("DAYNO", F.unix_date("DATE"))
    )
    frame = Window.partitionBy("ID").orderBy("DAYNO").rangeBetween(-(days - 1), 0)
    return (
        rows.withColumn("DATA", F.sort_array(F.collect_list(_entry(legacy_labels)).over(frame)))
        .filter(F.col("IN_SPINE") & (F.size("DATA") > 0))
        .select("ID", "DATE", "DATA")
    )
