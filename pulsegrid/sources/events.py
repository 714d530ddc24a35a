"""Upload documents made from an activity-event table, to run the engine on any event log.

Each event becomes one sample of one metric. Users whose id is a multiple of three upload every
document twice, and everybody's age changes after 2024-01-15, so repeats and changing profiles
occur in the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.catalogue import FACTS, FOOD
from pulsegrid.functions import clock
from pulsegrid.functions.numbers import settled
from pulsegrid.schema import RECORD

UNITS = {
    "ActiveEnergyBurned": "Cal", "AppleStandTime": "s", "BasalEnergyBurned": "Cal",
    "BodyMass": "lb", "DietaryEnergyConsumed": "Cal", "EnvironmentalAudioExposure": "dBASPL",
    "AppleExerciseTime": "min", "FlightsClimbed": "count", "HeadphoneAudioExposure": "dBASPL",
    "HeartRateVariabilitySDNN": "ms", "RestingHeartRate": "count/s", "StepCount": "count",
    "WalkingHeartRateAverage": "count/s", "DistanceWalkingRunning": "mi",
}
METRIC_SLOTS = 40  # slots past the fact list are sleep samples
BLOCK = 4096  # consecutive event ids per document at most
BLOOD_TYPES = ("A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-")
MEALS = ("Breakfast", "Lunch", "Dinner", "Snacks")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(
        "event_id", "user_id", "value", F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def _timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def event_samples(events: DataFrame, second_units: dict[str, str] | None = None) -> DataFrame:
    """One sample text per event, with the metric key it belongs to.

    Metrics in ``second_units`` come in that unit where ``k`` is odd, as from a phone whose settings change.
    """
    keys = [m.key for m in FACTS]
    slot = (F.col("event_id") % METRIC_SLOTS).cast("int")
    rows = events.select(
        "event_id", "user_id", "k", "value", clock.second_start(F.col("ts")).alias("start"),
        F.when(slot < len(keys), _pick(keys, F.least(slot, F.lit(len(keys) - 1))))
        .otherwise("SleepAnalysis").alias("key"),
    ).withColumn(
        "end", F.col("start") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.floor(F.col("value") * 60).cast("decimal(18,6)"))
    )
    key, k = F.col("key"), F.col("k")
    common = F.concat(
        F.lit(", 'uuid': '"), F.col("event_id").cast("string"),
        F.lit("', 'source': '"), F.when(k % 4 < 3, "Watch6,1").otherwise("iPhone14,2"),
        F.lit("', 'version': '9.1', 'start_time':'"), _timestamp_text(F.col("start")),
        F.lit("', 'end_time':'"), _timestamp_text(F.col("end")), F.lit("'"),
    )
    units = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    unit = F.when(
        key == "HeartRate", F.when(k % 2 == 0, "count/s").otherwise("count/min")
    ).otherwise(F.coalesce(F.try_element_at(units, key), F.lit("g")))
    for metric, second in (second_units or {}).items():
        unit = F.when((key == metric) & (k % 2 == 1), second).otherwise(unit)
    meal = F.concat(
        F.lit("'foodImageName': 'Food','foodType': 'Food "), k.cast("string"),
        F.lit("','USDANumber': '"), k.cast("string"),
        F.lit("','meal': '"), _pick(MEALS, k % 4), F.lit("'"),
    )
    is_meal = key.isin([m.key for m in FACTS if m.template == FOOD]) & (k % 2 == 0)
    element = F.when(
        key == "SleepAnalysis",
        F.concat(F.lit("{'value': "), (k % 6).cast("string"), common, F.lit("}")),
    ).otherwise(
        F.concat(
            F.lit("{'value': "), F.col("value").cast("string"), F.lit(", 'unit': '"), unit,
            F.lit("'"), common, F.lit(", 'metadata':{"),
            F.when(is_meal, meal).otherwise(""), F.lit("} }"),
        )
    )
    return rows.select("event_id", "user_id", clock.day(F.col("start")).alias("date"), "key",
                       element.alias("element"))


def _copies(user_id: Column) -> Column:
    return F.when(user_id % 3 == 0, F.array(F.lit("04"), F.lit("05"))).otherwise(
        F.array(F.lit("04"))
    )


def _profile(date: Column, hour: Column) -> list[Column]:
    user = F.col("user_id")
    age = 20 + user % 50 + F.when(date > F.lit("2024-01-15").cast("date"), 1).otherwise(0)
    return [
        user.cast("string").alias("identifier"),
        age.cast("string").alias("age"),
        F.when(user % 2 == 0, "Female").otherwise("Male").alias("gender"),
        _pick(BLOOD_TYPES, user % 8).alias("bloodstype"),
        F.lit("10001").alias("zip"),
        F.concat(F.date_add(date, 1).cast("string"), F.lit(" "), hour, F.lit(":00:00 +0000"))
        .alias("loaddate"),
    ]


def event_documents(events: DataFrame, block: int = BLOCK,
                    second_units: dict[str, str] | None = None) -> DataFrame:
    """Upload documents as JSON text, per user, day and ``block`` consecutive event ids.

    A phone sends one document per user and day. An event table has no such bound, so a day's document is
    cut: however busy a user is, no more than ``block`` samples meet in one row. Only the number of
    documents depends on it, no sample.
    """
    arrays = [
        F.collect_list(F.when(F.col("key") == m.key, F.col("element"))).alias(m.key) for m in FACTS
    ]
    cut = F.floor(F.col("event_id") / block).alias("block")
    documents = (
        event_samples(events, second_units).groupBy("user_id", "date", cut).agg(*arrays)
        .withColumn("hour", F.explode(_copies(F.col("user_id"))))
    )
    present = [
        F.when(F.size(m.key) > 0, F.col(m.key)).alias(m.key) for m in FACTS
    ]
    fields = _profile(F.col("date"), F.col("hour")) + present
    return documents.select(F.to_json(F.struct(*fields)).alias(RECORD))


def legacy_weight_documents(events: DataFrame) -> DataFrame:
    """Documents of the older form: body mass as a printed sample description."""
    start = clock.second_start(F.col("ts"))
    words = F.concat_ws(
        " ",
        F.col("value").cast("string"), F.lit("lb"), F.concat(F.lit("U"), F.col("event_id")),
        F.lit("\"Scale"), F.lit("App\""), F.lit("(2.1),"), F.lit("iPhone14,2"),
        F.lit("(15.4)"), F.lit("metadata:"), F.lit("{"), F.lit("entered"), F.lit("="), F.lit("1;"),
        F.lit("external"), F.concat(F.lit("X"), F.col("k")),
        F.concat(F.lit("("), F.date_format(start, "yyyy-MM-dd")),
        F.date_format(start, "HH:mm:ss"), F.lit("+0000"), F.lit("-)"),
    )
    return events.select(
        F.to_json(
            F.struct(F.col("user_id").cast("string").alias("identifier"),
                     F.array(words).alias("BodyMass"))
        ).alias(RECORD)
    )


def framed_uploads(documents: DataFrame) -> DataFrame:
    """Upload lines as they are delivered: an enveloped copy and a bare one, whose metrics go by their long type
    names, with nothing between."""
    long = F.regexp_replace(
        F.regexp_replace(RECORD, '"(SleepAnalysis)":', '"HKCategoryTypeIdentifier$1":'),
        f'"({"|".join(m.key for m in FACTS if m.key != "SleepAnalysis")})":', '"HKQuantityTypeIdentifier$1":')
    return documents.select(
        F.concat(F.lit('{"body":'), RECORD, F.lit("}"), long).alias("value")
    )


def broken_uploads(documents: DataFrame) -> DataFrame:
    """Landing documents some of which can't be taken in: cut off for users whose id is a multiple of 7, without an
    identifier for other multiples of 11, and an empty one for other multiples of 13."""
    user = F.get_json_object(RECORD, "$.identifier").cast("bigint")
    broken = (
        F.when(user % 7 == 0, F.expr(f"substring({RECORD}, 1, length({RECORD}) - 2)"))
        .when(user % 11 == 0, F.replace(RECORD, F.lit('"identifier"'), F.lit('"nobody"')))
        .when(user % 13 == 0, F.lit(" "))
        .otherwise(F.col(RECORD))
    )
    return documents.select(broken.alias(RECORD))


def graded_diets(user_days: DataFrame) -> DataFrame:
    """Training rows for the diet grader: a user's daily averages and a grade from their balance."""
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    rounded = lambda v: F.round(settled(v), 4)
    features = user_days.groupBy("ID").agg(
        rounded(mean("DIETARY_ENERGY") - mean("ACTIVE_ENERGY_BURNED")).alias("CAL_DIFF"),
        *[
            rounded(mean(source)).alias(name)
            for name, source in (("CARBS", "CARBS"), ("FAT", "FATTOTAL"), ("PROTEIN", "PROTEIN"),
                                 ("CHOL", "CHOLESTEROL"), ("SALT", "SODIUM"), ("SUGAR", "SUGAR"))
        ],
    )
    balance = F.col("CAL_DIFF")
    grade = (
        F.when(balance < -40, 1).when(balance < -10, 2).when(balance < 10, 3)
        .when(balance < 40, 4).otherwise(5)
    )
    return features.withColumn("GRADE", grade).withColumn(
        "DIET_NAME", F.when(F.col("SUGAR") > 50, "SWEET").otherwise("NEUTRAL")
    )
