"""The engine's tables for one source folder, written once per session and shared by queries."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators import extract, history, population, rollup
from pulsegrid.plans import wide
from pulsegrid.sources import events, tables
from pulsegrid.sources.dimensions import Calendar
from pulsegrid.sources.documents import parse_documents


class Workspace:
    """Tables are built when first asked for and kept in the shared folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = tables.new_path(spark, "tables")

    @cached_property
    def events(self) -> DataFrame:
        return events.read_events(self.spark, self.sf_dir)

    @cached_property
    def calendar(self) -> Calendar:
        """From the day before the first event, in local time, to the end of the last history."""
        first, last = self.events.agg(
            F.min("ts").cast("date"), F.max("ts").cast("date")
        ).first()
        first -= dt.timedelta(days=1)
        last += dt.timedelta(days=history.HISTORY_DAYS - 1)
        return Calendar(first, (last - first).days + 1)

    @cached_property
    def landing(self) -> DataFrame:
        return tables.store(events.event_documents(self.events), f"{self.root}/landing")

    @cached_property
    def documents(self) -> DataFrame:
        return parse_documents(self.landing)

    @cached_property
    def samples(self) -> DataFrame:
        return tables.store_samples(extract.samples(self.documents), f"{self.root}/samples")

    @cached_property
    def population(self) -> DataFrame:
        return tables.store(population.population(self.documents), f"{self.root}/population")

    @cached_property
    def user_days(self) -> DataFrame:
        rows = wide.samples_between(self.samples, self.calendar)
        return tables.store(rollup.user_days(rows), f"{self.root}/user_days")

    @cached_property
    def exceptional(self) -> DataFrame:
        rows = wide.samples_between(self.samples, self.calendar)
        return tables.store(wide.exceptional_days(rows), f"{self.root}/exceptional_days")

    @cached_property
    def pop_agg(self) -> DataFrame:
        """The wide table, parted by MONTH."""
        run_date = F.lit(self.calendar.last).cast("timestamp_ntz")
        df = wide.pop_agg(
            self.samples, self.population, self.calendar, run_date, by_month=True,
            days=self.user_days, exceptional=self.exceptional,
        )
        return wide.store_pop_agg(df, f"{self.root}/pop_agg")

    def fact(self, name: str) -> DataFrame:
        return extract.fact(self.samples, name)

    @property
    def sleep(self) -> DataFrame:
        return extract.sleep_fact(self.samples)

    @property
    def spine(self) -> DataFrame:
        return population.day_spine(self.population, self.calendar)


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        _open[key] = Workspace(spark, sf_dir)
    return _open[key]
