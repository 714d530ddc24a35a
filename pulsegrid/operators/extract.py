"""Documents to samples to fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.catalogue import (
    BY_FACT,
    CATALOGUE,
    FOOD,
    LOCAL_ZONE,
    MEASURE,
    SLEEP_STAGES,
    SLEEP_TEMPLATE,
)
from pulsegrid.functions import clock, text
from pulsegrid.functions.numbers import nearest_int
from pulsegrid.schema import RECORD, SAMPLE, document_schema

_FOOD_FIELDS = (
    ("FOODIMAGENAME", "foodImageName"),
    ("FOODTYPE", "foodType"),
    ("FOODUSDANUMBER", "USDANumber"),
    ("FOODMEAL", "meal"),
)


def _null_text() -> Column:
    return F.lit(None).cast("string")


def _one_of(metrics) -> Column:
    return F.col("METRIC").isin([m.fact for m in metrics])


def _where(metrics, value: Column, otherwise: Column) -> Column:
    """Pick by metric without testing when all or none of the catalogue qualifies."""
    return F.when(_one_of(metrics), value).otherwise(otherwise) if metrics else otherwise


def elements(documents: DataFrame, metrics=CATALOGUE) -> DataFrame:
    """ID, METRIC and the sample text, one row per array element of every metric."""
    pairs = F.array(
        *[F.struct(F.lit(m.fact).alias("M"), F.col(f"ARRAYS.{m.key}").alias("E")) for m in metrics]
    )
    return (
        documents.select("ID", F.inline(pairs).alias("METRIC", "E"))
        .select("ID", "METRIC", F.explode("E").alias("ELEMENT"))
    )


def parse_elements(rows: DataFrame, metrics=CATALOGUE) -> DataFrame:
    """Sample text to typed columns, with time zone, unit and template rules applied."""
    s = F.col("S")
    start, end = (clock.as_wall_clock(s[f]) for f in ("start_time", "end_time"))
    utc = [m for m in metrics if not m.local_time]
    no_uuid = [m for m in metrics if not m.keep_uuid]
    sleep = [m for m in metrics if m.template == SLEEP_TEMPLATE]
    food = [m for m in metrics if m.template == FOOD]
    per_minute = (F.col("METRIC") == "HEARTRATE") & (s["unit"] == "count/s")
    parsed = rows.select("ID", "METRIC", F.from_json("ELEMENT", SAMPLE).alias("S"))
    return parsed.select(
        "ID",
        "METRIC",
        _where(utc, start, clock.utc_to_zone(start, LOCAL_ZONE)).alias("STARTTIME"),
        _where(utc, end, clock.utc_to_zone(end, LOCAL_ZONE)).alias("ENDTIME"),
        F.when(per_minute, s["value"] * 60)
        .otherwise(_where(sleep, F.round(s["value"]), s["value"]))
        .alias("VALUE"),
        _where(sleep, F.lit("Sleep"), s["unit"]).alias("UNIT"),
        _where(no_uuid, _null_text(), s["uuid"]).alias("UUID"),
        s["source"].alias("DEVICE"),
        *[_where(food, s["metadata"][f], _null_text()).alias(c) for c, f in _FOOD_FIELDS],
    )


def samples(documents: DataFrame, metrics=CATALOGUE) -> DataFrame:
    """The long sample table: every metric from one pass over the documents, without repeats.

    Days are uploaded more than once. The repeats are removed by comparing whole rows, which
    shuffles on all columns, so neither a busy user nor a busy metric fills one partition, and
    copies of one sample are merged before the shuffle.
    """
    rows = parse_elements(elements(documents, metrics), metrics).dropDuplicates()
    return rows.withColumn("DAY", clock.day(F.col("STARTTIME")))


def extract_metric(documents: DataFrame, fact_name: str) -> DataFrame:
    """One fact table straight from documents (a scan per fact; ``samples`` scans once)."""
    metric = BY_FACT[fact_name]
    return _table(samples(documents, (metric,)), metric)


def fact(samples_df: DataFrame, fact_name: str, legacy_positions: bool = False,
         first_day=None, last_day=None) -> DataFrame:
    """One fact table; with days named, only their partitions of stored samples are read."""
    metric = BY_FACT[fact_name]
    rows = samples_df.filter(F.col("METRIC") == fact_name)
    if first_day is not None:
        rows = rows.filter(F.col("DAY").between(F.lit(first_day), F.lit(last_day)))
    return _table(rows, metric, legacy_positions)


def facts(samples_df: DataFrame, template: str) -> DataFrame:
    """All fact tables of one template together, told apart by METRIC."""
    metrics = [m for m in CATALOGUE if m.template == template]
    rows = samples_df.filter(_one_of(metrics))
    if template == SLEEP_TEMPLATE:
        return sleep_fact(rows)
    return _food(rows, False, "METRIC") if template == FOOD else _measure(rows, "METRIC")


def _table(rows: DataFrame, metric, legacy_positions: bool = False) -> DataFrame:
    if metric.template == FOOD:
        return _food(rows, legacy_positions)
    return _measure(rows) if metric.template == MEASURE else sleep_fact(rows)


def _measure(rows: DataFrame, *leading: str) -> DataFrame:
    return rows.select(
        *leading, "ID", "STARTTIME", "ENDTIME", "VALUE", "UNIT", "UUID",
        _null_text().alias("APP"), "DEVICE",
    )


def _food(rows: DataFrame, legacy_positions: bool, *leading: str) -> DataFrame:
    """Food columns bound by name.

    ``legacy_positions`` gives the values in the four food text columns in the order the original
    tables hold them, where header and values are shifted against each other.
    """
    text_columns = {
        "FOODMEAL": "FOODMEAL",
        "FOODTYPE": "FOODTYPE",
        "FOODTYPEUUID": None,
        "FOODUSDANUMBER": "FOODUSDANUMBER",
    }
    if legacy_positions:
        text_columns = {
            "FOODMEAL": "FOODTYPE",
            "FOODTYPE": "FOODUSDANUMBER",
            "FOODTYPEUUID": None,
            "FOODUSDANUMBER": "FOODMEAL",
        }
    return rows.select(
        *leading, "ID", "VALUE", "UNIT", "UUID", _null_text().alias("APP"), "DEVICE", "STARTTIME",
        "ENDTIME",
        _null_text().alias("EXTERNALUUID"), "FOODIMAGENAME",
        *[(F.col(v) if v else _null_text()).alias(c) for c, v in text_columns.items()],
    )


def sleep_stage(value: Column) -> Column:
    """Stage name of a sleep value; NULL for a value outside the list."""
    names = F.create_map(*[F.lit(x) for pair in SLEEP_STAGES for x in pair])
    return F.try_element_at(names, value)


def sleep_fact(samples_df: DataFrame) -> DataFrame:
    """Sleep samples recorded by a watch, with stage name and minutes."""
    return (
        samples_df.filter((F.col("METRIC") == "SLEEP") & F.col("DEVICE").ilike("Watch%"))
        .withColumn("VALUE", nearest_int(F.col("VALUE")))
        .select(
            "ID", "STARTTIME", "ENDTIME", "VALUE", "UNIT", "UUID", _null_text().alias("APP"),
            "DEVICE", sleep_stage(F.col("VALUE")).alias("CYCLE"),
            clock.minutes_crossed(F.col("STARTTIME"), F.col("ENDTIME")).alias("MINS"),
        )
    )


def legacy_weight(records: DataFrame) -> DataFrame:
    """Body mass from the older upload form, where a sample is a printed description."""
    doc = F.from_json(RECORD, document_schema(("BodyMass",)))
    rows = records.select(doc.alias("D")).select(
        F.col("D.identifier").alias("ID"), F.explode("D.BodyMass").alias("T")
    )
    t = F.col("T")
    joined = lambda *ns: F.concat_ws(" ", *[text.word(t, n) for n in ns])
    when = F.replace(joined(15, 16, 17), F.lit("("), F.lit(""))
    return rows.select(
        "ID",
        clock.as_wall_clock(when).alias("DATE"),
        text.quantity_value(t).alias("VALUE"),
        text.quantity_unit(t).alias("UNIT"),
        text.word(t, 2).alias("UUID"),
        joined(3, 4).alias("APP"),
        text.word(t, 6).alias("DEVICE"),
        text.word(t, 14).alias("EXTERNALUUID"),
    )
