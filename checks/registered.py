"""The queries the driver runs. Dates and times are given as text and numbers rounded, so that
results compare by value."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.catalogue import FOOD, HOURLY_SUMS, MEASURE, RAW_SERIES, SLEEP_TEMPLATE
from pulsegrid.functions import clock, text
from pulsegrid.functions.numbers import settled
from pulsegrid.operators import (
    extract, grading, history, insights, population, rollup, series, sizing, sleep,
)
from pulsegrid.plans import refresh, wide
from pulsegrid.plans.workspace import Workspace, workspace
from pulsegrid.schema import RECORD
from pulsegrid.sources import dimensions, documents, events, tables
from pulsegrid.streaming import ingest
from pulsegrid.streaming import rollup as stream_rollup

def presentable(df: DataFrame) -> DataFrame:
    def shown(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = clock.stamp(c.cast("timestamp_ntz"))
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(settled(c), 4)
        elif isinstance(f.dataType, (T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        return c.alias(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def _exploded(df: DataFrame, array: str = "DATA", outer: bool = False) -> DataFrame:
    """Array rows to element rows with their position.

    ``outer`` is for arrays that always have elements: the plain form also asks whether they do, which
    computes a derived array once more.
    """
    kept = [c for c in df.columns if c != array]
    explode = F.posexplode_outer if outer else F.posexplode
    rows = df.select(*kept, explode(array).alias("POS", "E"))
    element = df.schema[array].dataType.elementType
    return rows.select(
        *kept, "POS", *[F.col(f"E.{f.name}").alias("T" if f.name == "DATE" else f.name)
                        for f in element.fields]
    )


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _range(w: Workspace) -> tuple[dt.date, dt.date]:
    """The dashboard range used below: three weeks from the first day."""
    return w.calendar.start, w.calendar.start + dt.timedelta(days=21)


# --- dimensions, population, spines --------------------------------------------------------------

def steps_daily(w):
    docs = documents.parse_documents(w.landing)
    steps = rollup.daily_sum(extract.extract_metric(docs, "STEPCOUNT"))
    return w.spine.join(steps, ["ID", "DATE"], "left").select(
        "ID", "DATE", F.col("VALUE").alias("STEPS")
    )


def date_dim(w):
    per_day = w.samples.groupBy(F.col("DAY").alias("DATE")).agg(
        F.count("*").alias("N"), F.sum("VALUE").alias("TOTAL")
    )
    dim = dimensions.date_dim(w.spark)
    return dim.join(per_day, "DATE", "left").withColumns(
        {"N": F.coalesce("N", F.lit(0)), "TOTAL": F.coalesce("TOTAL", F.lit(0.0))}
    )


def date_dim_long(w):
    per_day = w.samples.groupBy(F.col("DAY").alias("DATE")).agg(F.count("*").alias("N"))
    dim = dimensions.date_dim(w.spark, dimensions.LONG_CALENDAR)
    return dim.join(per_day, "DATE", "left").withColumn("N", F.coalesce("N", F.lit(0)))


def hour_dim(w):
    per_hour = w.samples.groupBy(clock.hour_start(F.col("STARTTIME")).alias("DATE")).agg(
        F.count("*").alias("N")
    )
    dim = dimensions.hour_dim(w.spark)
    return dim.join(per_hour, "DATE", "left").withColumn("N", F.coalesce("N", F.lit(0)))


def population_latest(w):
    return population.population(w.documents)


def dated_pop(w):
    return population.day_spine(w.population)


def hours_pop(w):
    """The whole spine of 43,920 hours a user, told by its days."""
    hours = population.hour_spine(w.population)
    return hours.groupBy("ID", clock.day(F.col("DATE")).alias("DAY")).agg(
        F.count("*").alias("HOURS"), F.min("DATE").alias("FIRST"), F.max("DATE").alias("LAST")
    )


# --- extraction ----------------------------------------------------------------------------------

def extract_measure(w):
    return extract.facts(extract.samples(w.documents), MEASURE).drop("APP")


def extract_food(w):
    rows = extract.facts(extract.samples(w.documents), FOOD)
    return rows.drop("APP", "EXTERNALUUID", "FOODTYPEUUID")


def extract_sleep(w):
    return extract.facts(extract.samples(w.documents), SLEEP_TEMPLATE).drop("APP")


def food_legacy_positions(w):
    rows = extract.fact(w.samples, "CARBS", legacy_positions=True)
    return rows.select("ID", "UUID", "FOODMEAL", "FOODTYPE", "FOODUSDANUMBER")


def heart_rate_unit_norm(w):
    return extract.extract_metric(w.documents, "HEARTRATE").select(
        "ID", "STARTTIME", "VALUE", "UNIT", "UUID"
    )


def samples_long(w):
    return w.samples.drop("FOODIMAGENAME", "FOODTYPE", "FOODUSDANUMBER", "FOODMEAL")


def dedupe_samples(w):
    sent = extract.elements(w.documents).groupBy("METRIC").agg(F.count("*").alias("SENT"))
    kept = extract.samples(w.documents).groupBy("METRIC").agg(F.count("*").alias("KEPT"))
    return sent.join(kept, "METRIC")


def tz_convert(w):
    ts = clock.second_start(F.col("ts"))
    return w.events.select("event_id", ts.alias("UTC"), clock.utc_to_zone(ts, "America/New_York")
                           .alias("LOCAL"))


def sleep_minutes(w):
    start = F.col("ts")
    end = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                     F.floor(F.col("value") * 60).cast("decimal(18,6)"))
    return w.events.select("event_id", clock.minutes_crossed(start, end).alias("MINS"))


def device_filter(w):
    return w.sleep.groupBy("ID", "DEVICE").agg(F.count("*").alias("N"), F.sum("MINS").alias("MINS"))


def legacy_weight_text(w):
    return extract.legacy_weight(events.legacy_weight_documents(w.events))


def framed_documents(w):
    lines = events.framed_uploads(w.landing)
    path = tables.new_path(w.spark, "uploads")
    lines.write.option("lineSep", "\n").text(path)
    docs = documents.parse_documents(documents.read_documents(w.spark, path))
    n = F.lit(0)
    for f in docs.schema["ARRAYS"].dataType.fields:
        n = n + F.coalesce(F.array_size(F.col(f"ARRAYS.{f.name}")), F.lit(0))
    return docs.groupBy("ID", "AGE", "LOADTIME").agg(
        F.count("*").alias("DOCUMENTS"), F.sum(n).alias("ELEMENTS")
    )


def upload_backlog(w):
    """A backlog of upload files, taken into the landing table two files a batch."""
    uploads, landing, progress = (tables.new_path(w.spark, n) for n in ("backlog", "landing", "progress"))
    events.framed_uploads(w.landing).repartition(6).write.option("lineSep", "\n").text(uploads)
    ingest.start_landing(w.spark, uploads, landing, progress, once=True, files_per_batch=2).awaitTermination()
    docs = documents.parse_documents(w.spark.read.parquet(landing))
    return docs.groupBy("ID", "AGE", "LOADTIME").agg(F.count("*").alias("DOCUMENTS"))


def rejected_uploads(w):
    """Documents by what became of them, and the samples of those taken in."""
    uploads = events.broken_uploads(w.landing)
    known = documents.judged(uploads)
    taken = documents.accepted(known)
    path = tables.new_path(w.spark, "quarantine")
    quarantine = tables.store(documents.rejected(known), path)
    samples = extract.samples(documents.parse_documents(uploads, strict=True))
    reason = F.lit("accepted").alias("REASON")
    return quarantine.groupBy("REASON").agg(F.count("*").alias("N")).unionByName(
        taken.agg(F.count("*").alias("N")).select(reason, "N")).unionByName(
        samples.agg(F.count("*").alias("N")).select(F.lit("samples").alias("REASON"), "N"))


def device_side_split(w):
    described = F.concat_ws(" ", F.col("value").cast("string"), F.lit("count/s"))
    identity = F.concat_ws("|", F.col("user_id").cast("string"), F.lit("10001"))
    quoted = F.concat(F.lit("\"'"), F.col("event_type"), F.lit("' \""), F.col("k").cast("string"))
    sent = F.concat(F.date_format(clock.second_start(F.col("ts")), "yyyy-MM-dd HH:mm:ss"), F.lit(" +0000"))
    return w.spark.read.parquet(f"{w.sf_dir}/events.parquet").select(
        "event_id", "user_id", "value", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k")).select(
        text.drop_quotes(quoted).alias("PLAIN"), text.drop_utc_offset(sent).alias("SENT"),
        "event_id", text.quantity_value(described).alias("VALUE"),
        text.quantity_unit(described).alias("UNIT"),
        text.identity_id(identity).alias("ID"), text.identity_zip(identity).alias("ZIP"),
    )


def calendar_age(w):
    orders = w.spark.read.parquet(f"{w.sf_dir}/orders.parquet")
    born, as_of = F.col("o_orderdate").cast("date"), F.lit(dt.date(2024, 2, 28))
    return orders.select("o_orderkey", clock.age_on(born, as_of).alias("AGE"))


# --- totals and series ---------------------------------------------------------------------------

def daily_sum(w):
    return rollup.daily_sum(w.fact("ACTIVE_ENERGY_BURNED"))


def mixed_units(w):
    every_metric = w.samples.withColumn("METRIC", F.lit("STEPCOUNT"))
    return rollup.mixed_units(every_metric)


def daily_wide_pivot(w):
    return rollup.daily_wide(w.samples, w.spine)


def daily_wide_joins(w):
    return rollup.daily_wide_joins(w.samples, w.spine)


def hourly_zero_fill(w):
    hours = population.hour_spine(w.population, w.calendar)
    return rollup.hourly_fill(w.fact("STEPCOUNT"), hours)


def hourly_array(w):
    return _exploded(rollup.hourly_series(w.fact("BASALENERGYBURNED"), w.spine), outer=True)


def raw_series_array(w):
    return _exploded(series.raw_series(w.samples, "ENVIRONMENTAUDIO"))


def hr_hourly_distinct(w):
    rows = _exploded(series.hourly_distinct(w.samples, w.spine))
    return rows.withColumn("val", F.round(F.nullif("val", F.lit("")).cast("double"), 4))


def sleep_nightly(w):
    return sleep.sleep_nightly(w.sleep)


def sleep_segments(w):
    return _exploded(sleep.sleep_segments(w.sleep))


def sleep_hour_normalised(w):
    return _exploded(sleep.normalise_sleep(sleep.sleep_segments(w.sleep)))


def sleep_hour_keep_tail(w):
    return _exploded(sleep.normalise_sleep(sleep.sleep_segments(w.sleep), keep_tail=True))


def _timeline(w):
    """A night begins on the evening before: only the days of the range and that one are read."""
    start, end = _range(w)
    stages = extract.fact(w.samples, "SLEEP", first_day=start - dt.timedelta(days=1), last_day=end)
    return sleep.sleep_timeline(stages, start, end)


def sleep_timeline(w):
    return _timeline(w)


def sleep_minute_strip(w):
    return sleep.sleep_strip(_timeline(w))


def energy_daily(w):
    return history.daily_energy(w.samples)


def energy_history_10d(w):
    return _exploded(history.energy_history(history.daily_energy(w.samples), w.calendar))


def energy_history_legacy(w):
    energy = history.energy_of_days(w.user_days)
    return _exploded(history.energy_history(energy, w.calendar, legacy_labels=True))


def energy_history_window(w):
    return _exploded(history.energy_history_window(history.daily_energy(w.samples), w.spine))


# --- wide table ----------------------------------------------------------------------------------

def _cents(v: Column) -> Column:
    return F.when(v == 0, "0").otherwise(F.round(v * 100).cast("bigint").cast("string"))


def _maybe_null(array: Column, kind: type) -> Column:
    """The array as one whose elements may be NULL, as those it is compared with are; else each comparison casts it."""
    element = {float: T.DoubleType(), str: T.StringType(), dt.datetime: T.TimestampNTZType()}[kind]
    return array.cast(T.ArrayType(element))


def _pop_agg_text(df: DataFrame) -> DataFrame:
    """Arrays as text, element by element.

    What the elements of a row share is put into words once a row: the hours of its day, and the whole text of an
    array with 0 or '' in every hour. Elements at other times are put into words one by one.
    """
    def stamp(x: Column) -> Column:
        at = F.hour(x["DATE"])
        return F.when(x["DATE"] == F.get("HOUR", at), F.get("HOUR_TEXT", at)).otherwise(clock.stamp(x["DATE"]))

    def joined(column: str, element) -> Column:
        return F.array_join(F.transform(column, element), ";")

    def when_empty(column: str, value, text: str) -> Column:
        values = _maybe_null(F.array(*[F.lit(value)] * 24), type(value))
        return F.when((F.col(column)["val"] == values) & (F.col(column)["DATE"] == F.col("HOUR")), F.col(text))

    def empty_text(value: str) -> Column:
        return F.concat(F.array_join("HOUR_TEXT", f"={value};"), F.lit(f"={value}"))

    plain = lambda x: F.concat_ws("=", stamp(x), _cents(x["val"]))
    heart = lambda x: F.concat_ws(
        "=", stamp(x), F.coalesce(_cents(F.nullif(x["val"], F.lit("")).cast("double")), F.lit(""))
    )
    night = lambda x: F.concat_ws("=", stamp(x), x["cycle"], _cents(x["val"]))
    week = lambda x: F.concat_ws(
        "=", stamp(x), _cents(x["ACTIVE"]), _cents(x["BASAL"]), _cents(x["CONSUMED"])
    )
    arrays = {
        **{c: when_empty(c, 0.0, "ZEROS_TEXT").otherwise(joined(c, plain)) for c, _ in HOURLY_SUMS},
        **{c: joined(c, plain) for c, _ in RAW_SERIES},
        "HEART_RATE_ARR": when_empty("HEART_RATE_ARR", "", "BLANKS_TEXT").otherwise(joined("HEART_RATE_ARR", heart)),
        "SLEEP_ARR": joined("SLEEP_ARR", night), "WEEK_CALS_ARR": joined("WEEK_CALS_ARR", week),
    }
    once_a_row = df.withColumns({
        "HOUR": _maybe_null(clock.hours_of(F.col("DATE")), dt.datetime), "HOUR_TEXT": clock.hour_stamps(F.col("DATE")),
    }).withColumns({"ZEROS_TEXT": empty_text("0"), "BLANKS_TEXT": empty_text("")})
    shown = once_a_row.select(
        *[arrays[c].alias(c) if c in arrays else F.col(c) for c in df.columns if c not in ("RUN_DATE", "MONTH")]
    )
    return _doubles(shown, "SLEEP")


def pop_agg(w):
    return _pop_agg_text(w.pop_agg)


def pop_agg_run_date(w):
    return w.pop_agg.groupBy("ID", "RUN_DATE").agg(F.count("*").alias("N"), F.countDistinct("MONTH").alias("MONTHS"))


SECOND_UNITS = {"StepCount": "steps", "ActiveEnergyBurned": "kJ", "DietaryCarbohydrates": "oz"}


def pop_agg_mixed_units(w):
    """Few, busy users whose phones change units: days with several units have a row for each combination."""
    busy = w.events.withColumn("user_id", F.col("user_id") % 5)
    docs = documents.parse_documents(events.event_documents(busy, second_units=SECOND_UNITS))
    samples = tables.store_samples(extract.samples(docs), tables.new_path(w.spark, "mixed"))
    df = wide.pop_agg(samples, population.population(docs), w.calendar, F.lit(w.calendar.last).cast("timestamp_ntz"))
    return df.select("ID", "DATE", "STEPS", "ACTIVE_ENERGY_BURNED", "CARBS", "PROTEIN", "BODYMASS")


def pop_agg_bucketed(w):
    """The wide table over user-days that are stored in buckets by user and day."""
    days = tables.store_bucketed(w.user_days, tables.new_path(w.spark, "buckets"), 8, "ID", "DATE")
    run_date = F.lit(w.calendar.last).cast("timestamp_ntz")
    return _pop_agg_text(wide.pop_agg(w.samples, w.population, w.calendar, run_date, days=days,
                                      exceptional=w.exceptional))


def clustered_fact(w):
    """Three weeks of heart rates, from a fact table that is clustered by user and time."""
    start, end = _range(w)
    fact = tables.store_fact(w.fact("HEARTRATE"), tables.new_path(w.spark, "fact"))
    day = clock.day(F.col("STARTTIME"))
    return fact.filter(day.between(F.lit(start), F.lit(end))).select("ID", "STARTTIME", "VALUE", "UNIT", "UUID")


def full_refresh(w):
    root = tables.new_path(w.spark, "refresh")
    refresh.full_refresh(w.landing, root, w.calendar, F.lit(w.calendar.last).cast("timestamp_ntz"))
    return _pop_agg_text(tables.current(w.spark, root, "pop_agg"))


def incremental_refresh(w):
    """Uploads taken in as two batches, split by load time."""
    root = tables.new_path(w.spark, "batches")
    middle = (w.calendar.start + dt.timedelta(days=16)).isoformat()
    early = F.get_json_object(RECORD, "$.loaddate") < middle
    refresh.refresh_batch(w.landing.filter(early), 0, root, w.calendar)
    refresh.refresh_batch(w.landing.filter(~early), 1, root, w.calendar)
    return _pop_agg_text(refresh.stored_pop_agg(w.spark, root, w.calendar))


def _upload_files(w, path: str) -> None:
    events.framed_uploads(w.landing).write.option("lineSep", "\n").text(path)


def upload_stream_refresh(w):
    """The upload stream, from files to the wide table."""
    uploads, root, progress = (tables.new_path(w.spark, n) for n in ("inbox", "live", "progress"))
    _upload_files(w, uploads)
    ingest.start_refresh(w.spark, uploads, root, progress, once=True).awaitTermination()
    refresh.compact(w.spark, root)
    return _pop_agg_text(refresh.stored_pop_agg(w.spark, root, w.calendar))


def refresh_restarted_checkpoint(w):
    """Two uploads by streams that both count their batches from 0, as after the loss of a checkpoint."""
    root = tables.new_path(w.spark, "restarted")
    middle = (w.calendar.start + dt.timedelta(days=16)).isoformat()
    early = F.get_json_object(RECORD, "$.loaddate") < middle
    for part in (w.landing.filter(~early), w.landing.filter(early)):
        uploads, progress = tables.new_path(w.spark, "inbox"), tables.new_path(w.spark, "progress")
        events.framed_uploads(part).write.option("lineSep", "\n").text(uploads)
        ingest.start_refresh(w.spark, uploads, root, progress, once=True).awaitTermination()
    return _pop_agg_text(refresh.stored_pop_agg(w.spark, root, w.calendar))


def many_small_batches(w):
    """Uploads in four batches, merged after every second one; levels of two, so older runs are merged again."""
    root, parts = tables.new_path(w.spark, "small"), 4
    for part in range(parts):
        refresh.refresh_batch(
            w.landing.filter(F.pmod(F.xxhash64(RECORD), F.lit(parts)) == part), None, root, w.calendar)
        if part % 2:
            refresh.compact(w.spark, root, fanout=2)
    return _pop_agg_text(refresh.stored_pop_agg(w.spark, root, w.calendar))


def _in_parts(w):
    """The wide table cut into parts of three samples."""
    run_date = F.lit(w.calendar.last).cast("timestamp_ntz")
    exceptional = wide.exceptional_days(wide.samples_between(w.samples, w.calendar), 3)
    return wide.pop_agg(w.samples, w.population, w.calendar, run_date, days=w.user_days, part_items=3,
                        exceptional=exceptional)


def pop_agg_in_parts(w):
    """Parts of a user-day put together again are the user-day."""
    text = _pop_agg_text(_in_parts(w).withColumn("RUN_DATE", F.lit(None)))
    series = [c for c, _ in RAW_SERIES] + ["HEART_RATE_ARR"]
    put = [
        F.nullif(F.array_join(F.transform(
            F.sort_array(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("PART", c)))), lambda x: x[c]
        ), ";"), F.lit("")).alias(c) if c in series else F.max(F.when(F.col("PART") == 0, F.col(c))).alias(c)
        for c in text.columns if c not in ("ID", "DATE", "PART")
    ]
    return text.groupBy("ID", "DATE").agg(*put).withColumn("PART", F.lit(0)).select(*text.columns)


def macro_calories_in_parts(w):
    return insights.macro_calories(insights.trend(_in_parts(w), *_range(w)))


# --- dashboard -----------------------------------------------------------------------------------

def _trend(w):
    return insights.trend(w.pop_agg, *_range(w))


def trend_slice(w):
    return _doubles(
        _trend(w).select("ID", "DATE", "AGE", "GENDER", "BLOODTYPE", "STEPS", "SLEEP", "CARBS"),
        "SLEEP",
    )


def trend_user(w):
    """One user's range in order of date, as the dashboard asks for it."""
    user = w.population.agg(F.min("ID")).first()[0]
    rows = insights.trend(w.pop_agg, *_range(w), id=user)
    return _doubles(rows.select("ID", "DATE", "AGE", "STEPS", "SLEEP", "CARBS"), "SLEEP")


def kpi_averages(w):
    k = insights.kpis(_trend(w))
    return _doubles(k, *[c for c in k.columns if c not in ("ID", "GENDER", "BLOODTYPE")])


def kpi_nutrition(w):
    k = insights.nutrition_kpis(_trend(w))
    return _doubles(k, *k.columns[1:])


def macro_calories(w):
    return insights.macro_calories(_trend(w))


def burned_calories(w):
    return insights.burned_calories(_trend(w))


def melt_macros(w):
    return insights.melt(insights.macro_calories(_trend(w)))


def calories_long(w):
    t = _trend(w)
    return insights.long_calories(insights.macro_calories(t)).unionByName(
        insights.long_calories(insights.burned_calories(t))
    )


def chart_ceiling(w):
    return insights.chart_ceiling(_trend(w))


def weight_domain(w):
    return insights.value_range(_trend(w), "BODYMASS", "ID")


def calorie_balance(w):
    return _doubles(insights.calorie_balance(_trend(w), *_range(w)), "DAYS_PER_POUND")


def heart_kpis(w):
    k = insights.heart_kpis(w.samples, *_range(w))
    return _doubles(k, *k.columns[1:])


def _heart_points(w, include_end_day: bool = False):
    start, end = _range(w)
    rates = extract.fact(w.samples, "HEARTRATE", first_day=start, last_day=end)
    return insights.heart_points(rates, start, end, include_end_day)


def heart_points(w):
    return _heart_points(w)


def heart_domain(w):
    return insights.value_range(_heart_points(w), "HR", "ID")


def heart_domain_end_day(w):
    return insights.value_range(_heart_points(w, include_end_day=True), "HR", "ID")


def meal_calories(w):
    return insights.meal_calories(w.fact("DIETARYENERGY"))


def meal_calories_top(w):
    return tables.top(insights.meal_calories(w.fact("DIETARYENERGY")), 10, "ID", "DATE", "TIME")


def fetched_meals(w):
    """The same ten rows, fetched to the client as a display would."""
    rows = tables.top(insights.meal_calories(w.fact("DIETARYENERGY")), 10, "ID", "DATE", "TIME")
    shown = tables.fetch(rows.withColumn("DATE", F.col("DATE").cast("string")), 10)
    return w.spark.createDataFrame(shown, "ID string, DATE string, TIME string, CALS double")


def scanned_table(w):
    """A stored table by its name and its own list of columns."""
    tables.share({"POPULATION_V": w.population})
    return w.spark.table("POPULATION_V").select(*tables.column_names(w.spark, "POPULATION_V"))


def today_total(w):
    return insights.day_total(w.samples, "STEPCOUNT", w.calendar.start + dt.timedelta(days=10))


def latest_sample(w):
    return insights.latest_sample(w.samples)


def sql_query(w):
    tables.share({"POP_AGG_V": w.pop_agg})
    start, end = _range(w)
    return tables.query(
        w.spark,
        "SELECT ID, DATE, STEPS FROM POP_AGG_V "
        "WHERE ID <> :pin AND DATE BETWEEN :first AND :last AND STEPS > :steps",
        pin="NOBODY", first=start, last=end, steps=100.0,
    )


# --- storage, model, streams ---------------------------------------------------------------------

def published_versions(w):
    root = tables.new_path(w.spark, "published")
    totals = rollup.daily_sum(w.fact("STEPCOUNT"))
    tables.publish(totals.withColumn("VALUE", F.lit(0.0)), root)
    tables.publish(totals, root, view="STEP_TOTALS")
    return w.spark.table("STEP_TOTALS")


def graded_csv(w):
    path = tables.new_path(w.spark, "graded")
    diets = events.graded_diets(w.user_days)
    whole = lambda c: F.round(c).cast("int").alias(c)
    diets.select(
        *[whole(c) for c in ("CAL_DIFF", "CARBS", "FAT", "PROTEIN")], "CHOL", "SALT", "SUGAR",
        "GRADE",
    ).write.option("header", True).option("lineSep", "\n").csv(path)
    return tables.read_graded_csv(w.spark, path).groupBy("GRADE").agg(
        F.count("*").alias("N"), F.sum("CAL_DIFF").alias("CAL_DIFF"), F.sum("SUGAR").alias("SUGAR")
    )


def diet_grade_predict(w):
    diets = tables.store(events.graded_diets(w.user_days), tables.new_path(w.spark, "diets"))
    root = tables.new_path(w.spark, "models")
    names = sorted(r[0] for r in diets.select("DIET_NAME").distinct().collect())
    found = []
    for name in names:
        grading.register_model(w.spark, grading.train_grader(diets, name), root, name)
        model, rows = grading.load_model(root, name), diets.filter(F.col("DIET_NAME") == name)
        graded = grading.predict_grade(model, rows.withColumn("GIVEN", F.col("GRADE")))
        eaten = grading.with_calorie_difference(
            rows.select("ID", (F.col("CAL_DIFF") + 2000).alias("EATEN"), F.lit(2000.0).alias("BURNED"),
                        *grading.FEATURES[1:]), F.col("EATEN"), F.col("BURNED"))
        again = grading.predict_grade(model, eaten).select("ID", F.col("GRADE").alias("AGAIN"))
        found.append(graded.join(again, "ID").groupBy("DIET_NAME").agg(
            F.count("*").alias("N"), F.countDistinct("GIVEN").alias("GRADES"),
            F.round(F.sum("CAL_DIFF"), 2).alias("CAL_DIFF"),
            (F.size(F.array_except(F.collect_set("GRADE"), F.collect_set("GIVEN"))) == 0).alias("KNOWN"),
            (F.avg((F.col("GRADE") == F.col("GIVEN")).cast("double")) >= ACCURACY).alias("ACCURATE"),
            (F.avg((F.col("GRADE") == F.col("AGAIN")).cast("double")) >= 0.95).alias("SAME"),
        ))
    listed = w.spark.read.parquet(f"{root}/model_list").select(F.col("MODEL_NAME").alias("DIET_NAME"))
    return reduce(DataFrame.unionByName, found).join(listed, "DIET_NAME")


def diet_grade_held_out(w):
    """From the CSV to held-out grades: every row is graded once, by a model that has not seen it or its like."""
    path = tables.new_path(w.spark, "graded")
    whole = lambda c: F.round(c).cast("int").alias(c)
    events.graded_diets(w.user_days).select(
        *[whole(c) for c in ("CAL_DIFF", "CARBS", "FAT", "PROTEIN")], "CHOL", "SALT", "SUGAR", "GRADE",
    ).write.option("header", True).option("lineSep", "\n").csv(path)
    graded, root = tables.read_graded_csv(w.spark, path), tables.new_path(w.spark, "models")
    found = tables.store(grading.cross_validated(graded, max_iterations=300), tables.new_path(w.spark, "folds"))
    grading.register_model(w.spark, grading.train_grader(graded, max_iterations=300), root, "ALL", found)
    metrics = w.spark.read.parquet(f"{root}/model_metrics")
    spread = found.agg(F.bool_and((F.col("TRAINED") > 0) & (F.col("N") > 0)).alias("DEALT"))
    share = F.col("CORRECT") / F.col("N")
    judged = F.when(F.col("N") >= JUDGED_ROWS, share >= HELD_OUT)
    return metrics.crossJoin(spread).select("MODEL_NAME", "N", "DEALT", judged.alias("ACCURATE"))


#: Least share of held-out rows that are graded as given (the commonest grade alone is about half of the rows), and the
#: number of rows from which that is a statement about the model.
HELD_OUT, JUDGED_ROWS = 0.6, 100


#: Least share of training rows that a diet's model grades as given.
ACCURACY = 0.8


def _totals_in_two(w, name: str, parts, **options) -> str:
    """Exact totals by two streams, each with a checkpoint of its own."""
    root = tables.new_path(w.spark, name)
    for part in parts:
        inbox, progress = tables.new_path(w.spark, "part"), tables.new_path(w.spark, "progress")
        part.write.parquet(inbox)
        stream = w.spark.readStream.schema(part.schema).parquet(inbox)
        stream_rollup.start_totals(stream, root, progress, **options).awaitTermination()
    return root


def stream_late_totals(w):
    """Exact totals when the later half of the days arrives first, by two streams that start afresh."""
    middle = w.calendar.start + dt.timedelta(days=16)
    days = (F.col("DAY") > middle, F.col("DAY") <= middle)
    root = _totals_in_two(w, "late", [w.samples.filter(d) for d in days])
    return stream_rollup.totals(w.spark, root)


def landing_change_stream(w):
    """Two readers of one landing table, each with its own place: one refreshes totals, one counts profiles."""
    uploads, landing, seen, totals = (tables.new_path(w.spark, n) for n in ("inbox", "landing", "seen", "totals"))
    events.framed_uploads(w.landing).repartition(4).write.option("lineSep", "\n").text(uploads)
    place = lambda: tables.new_path(w.spark, "place")
    ingest.start_landing(w.spark, uploads, landing, place(), once=True, files_per_batch=2).awaitTermination()
    profiles = documents.parse_documents(ingest.landing_changes(w.spark, landing, 1)).select("ID", "LOADTIME")
    profiles.writeStream.format("parquet").option("path", seen).option("checkpointLocation", place()).trigger(
        availableNow=True).start().awaitTermination()
    docs = documents.parse_documents(ingest.landing_changes(w.spark, landing))
    stream_rollup.start_totals(extract.parse_elements(extract.elements(docs)), totals, place()).awaitTermination()
    known = w.spark.read.parquet(seen).groupBy("ID").agg(F.count("*").alias("UPLOADS"))
    return stream_rollup.totals(w.spark, totals).join(known, "ID")


def stream_restarted_totals(w):
    """Two streams over mixed days, the second with repeats of the first and rows far behind; the side table is merged
    and the batches are gathered before the totals are read."""
    half = F.pmod(F.xxhash64("UUID", "STARTTIME"), F.lit(3))
    root = _totals_in_two(w, "restart", [w.samples.filter(half < 2), w.samples.filter(half > 0)])
    stream_rollup.merge_late(w.spark, root)
    stream_rollup.compact_totals(w.spark, root)
    return stream_rollup.totals(w.spark, root)


def _sample_stream(w):
    """Samples of the event table as a stream, with the repeated uploads in it."""
    source = w.spark.read.parquet(f"{w.sf_dir}/events.parquet").schema
    raw = w.spark.readStream.schema(source).parquet(f"{w.sf_dir}/events.parquet*")
    rows = raw.select(
        "event_id", "user_id", "value", F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    names = F.create_map(*[
        F.lit(x) for m in extract.CATALOGUE for x in (m.key, m.fact)
    ])
    sent = events.event_samples(rows).select(
        F.col("user_id").cast("string").alias("ID"), F.element_at(names, F.col("key")).alias("METRIC"),
        F.col("element").alias("ELEMENT"),
        F.explode(F.when(F.col("user_id") % 3 == 0, F.sequence(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("COPY"),
    )
    return extract.parse_elements(sent)


def _run(w, stream, name: str) -> str:
    root = tables.new_path(w.spark, name)
    checkpoint = tables.new_path(w.spark, f"{name}-progress")
    stream_rollup.start(stream, root, checkpoint).awaitTermination()
    return root


def stream_daily_totals(w):
    root = _run(w, stream_rollup.windowed_totals(_sample_stream(w), "1 day"), "daily")
    return stream_rollup.windows(w.spark, root)


def stream_hourly_totals(w):
    root = _run(w, stream_rollup.windowed_totals(_sample_stream(w), "1 hour"), "hourly")
    return stream_rollup.windows(w.spark, root)


def stream_dedupe(w):
    root = tables.new_path(w.spark, "once")
    checkpoint = tables.new_path(w.spark, "once-progress")
    stream = stream_rollup.dedupe(_sample_stream(w))
    stream_rollup.start(stream, root, checkpoint, "append").awaitTermination()
    kept = w.spark.read.parquet(root)
    return kept.groupBy("METRIC").agg(F.count("*").alias("KEPT"), F.sum("VALUE").alias("TOTAL"))


QUERIES = (
    steps_daily, date_dim, date_dim_long, hour_dim, population_latest, dated_pop, hours_pop,
    extract_measure, extract_food, extract_sleep, food_legacy_positions, heart_rate_unit_norm,
    samples_long, dedupe_samples, tz_convert, sleep_minutes, device_filter, legacy_weight_text,
    framed_documents, upload_backlog, rejected_uploads, device_side_split, calendar_age,
    daily_sum, mixed_units, daily_wide_pivot, daily_wide_joins, hourly_zero_fill, hourly_array,
    raw_series_array, hr_hourly_distinct, sleep_nightly, sleep_segments, sleep_hour_normalised,
    sleep_hour_keep_tail, sleep_timeline, sleep_minute_strip, energy_daily, energy_history_10d,
    energy_history_legacy, energy_history_window,
    pop_agg, pop_agg_run_date, pop_agg_mixed_units, pop_agg_bucketed, clustered_fact, full_refresh, incremental_refresh, many_small_batches, upload_stream_refresh, refresh_restarted_checkpoint,
    pop_agg_in_parts, macro_calories_in_parts,
    trend_slice, trend_user, kpi_averages, kpi_nutrition, macro_calories, burned_calories, melt_macros,
    calories_long, chart_ceiling, weight_domain, calorie_balance, heart_kpis, heart_points,
    heart_domain, heart_domain_end_day, meal_calories, meal_calories_top, fetched_meals, scanned_table, today_total, latest_sample, sql_query,
    published_versions, graded_csv, diet_grade_predict, diet_grade_held_out,
    stream_daily_totals, stream_hourly_totals, stream_dedupe, stream_late_totals,
    stream_restarted_totals, landing_change_stream,
)


def _registered(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables.local_folder(spark)
        sizing.compiled_methods(spark)
        return presentable(build(workspace(spark, sf_dir)))

    return run


def queries():
    return {q.__name__: _registered(q) for q in QUERIES}
