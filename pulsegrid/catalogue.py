"""Which metrics exist, how each is extracted, and where it lands in the wide table."""

from __future__ import annotations

from typing import NamedTuple

MEASURE, FOOD, SLEEP_TEMPLATE = "measure", "food", "sleep"

LOCAL_ZONE = "America/New_York"


class Metric(NamedTuple):
    key: str  # array key in the upload document
    fact: str  # fact table name
    template: str
    local_time: bool = True  # UTC sample times are moved to LOCAL_ZONE
    keep_uuid: bool = True


# Upload key, fact table, column template.
FACTS = (
    Metric("ActiveEnergyBurned", "ACTIVE_ENERGY_BURNED", MEASURE),
    Metric("AppleStandTime", "APPLESTANDTIME", MEASURE),
    Metric("BasalEnergyBurned", "BASALENERGYBURNED", MEASURE, local_time=False),
    Metric("BodyMass", "BODYMASS", MEASURE, keep_uuid=False),
    Metric("DietaryCarbohydrates", "CARBS", FOOD),
    Metric("DietaryCholesterol", "CHOLESTEROL", FOOD),
    Metric("DietaryEnergyConsumed", "DIETARYENERGY", FOOD),
    Metric("EnvironmentalAudioExposure", "ENVIRONMENTAUDIO", MEASURE),
    Metric("AppleExerciseTime", "EXERCISETIME", MEASURE),
    Metric("DietaryFatMonounsaturated", "FATMONO", FOOD),
    Metric("DietaryFatPolyunsaturated", "FATPOLY", FOOD),
    Metric("DietaryFatSaturated", "FATSAT", FOOD),
    Metric("DietaryFatTotal", "FATTOTAL", FOOD),
    Metric("FlightsClimbed", "FLIGHTSCLIMBED", MEASURE),
    Metric("HeadphoneAudioExposure", "HEAPHONEAUDIO", MEASURE),
    Metric("HeartRate", "HEARTRATE", MEASURE),
    Metric("HeartRateVariabilitySDNN", "HEARTRATESDNN", MEASURE),
    Metric("DietaryProtein", "PROTEIN", FOOD),
    Metric("RestingHeartRate", "RESTINGHEARTRATE", MEASURE),
    Metric("SleepAnalysis", "SLEEP", SLEEP_TEMPLATE),
    Metric("DietarySodium", "SODIUM", FOOD),
    Metric("StepCount", "STEPCOUNT", MEASURE),
    Metric("DietarySugar", "SUGAR", FOOD),
    Metric("WalkingHeartRateAverage", "WALKINGHEARTAVG", FOOD),
    Metric("DistanceWalkingRunning", "WALKRUNDISTANCE", FOOD),
)

# Uploaded by the phone but not part of any fact table; kept in the long table.
UPLOADED_ONLY = (
    Metric("BodyMassIndex", "BODYMASSINDEX", MEASURE),
    Metric("DietaryWater", "DIETARYWATER", FOOD),
    Metric("WaistCircumference", "WAISTCIRCUMFERENCE", MEASURE),
)

CATALOGUE = FACTS + UPLOADED_ONLY

BY_FACT = {m.fact: m for m in CATALOGUE}

# Wide-table column and the fact it sums per day.
DAILY_SUMS = (
    ("ACTIVE_ENERGY_BURNED", "ACTIVE_ENERGY_BURNED"),
    ("APPLE_STAND_TIME", "APPLESTANDTIME"),
    ("BASAL_ENERGY_BURNED", "BASALENERGYBURNED"),
    ("CARBS", "CARBS"),
    ("CHOLESTEROL", "CHOLESTEROL"),
    ("DIETARY_ENERGY", "DIETARYENERGY"),
    ("FATMONO", "FATMONO"),
    ("FATPOLY", "FATPOLY"),
    ("FATSAT", "FATSAT"),
    ("FATTOTAL", "FATTOTAL"),
    ("FLIGHTSCLIMBED", "FLIGHTSCLIMBED"),
    ("PROTEIN", "PROTEIN"),
    ("SODIUM", "SODIUM"),
    ("STEPS", "STEPCOUNT"),
    ("SUGAR", "SUGAR"),
    ("WALK_RUN", "WALKRUNDISTANCE"),
    ("EXERCISE_TIME", "EXERCISETIME"),
    ("BODYMASS", "BODYMASS"),
)

# Wide-table array column and the fact whose hourly sums it holds.
HOURLY_SUMS = (
    ("STAND_TIME_ARR", "APPLESTANDTIME"),
    ("FLIGHTS_ARR", "FLIGHTSCLIMBED"),
    ("WALK_RUN_ARR", "WALKRUNDISTANCE"),
    ("STEPS_ARR", "STEPCOUNT"),
    ("ACTIVE_ENERGY_ARR", "ACTIVE_ENERGY_BURNED"),
    ("BASAL_ARR", "BASALENERGYBURNED"),
    ("EXERCISE_TIME_ARR", "EXERCISETIME"),
)

# Wide-table array column and the fact whose samples it lists.
RAW_SERIES = (
    ("REST_HEART_RATE_ARR", "RESTINGHEARTRATE"),
    ("SDNN_HEART_RATE_ARR", "HEARTRATESDNN"),
    ("WALK_HEART_RATE_ARR", "WALKINGHEARTAVG"),
    ("ENVIRONMENT_AUDIO_ARR", "ENVIRONMENTAUDIO"),
    ("HEADPHONE_AUDIO_ARR", "HEAPHONEAUDIO"),
)

# Sleep sample value and its stage name.
SLEEP_STAGES = (
    (0, "InBed"),
    (1, "Unknown"),
    (2, "awake"),
    (3, "Core"),
    (4, "Deep"),
    (5, "REM"),
)
ASLEEP_STAGES = (3, 4, 5)
# Stages counted when a night is laid out by clock hour, in output order.
HOURLY_CYCLES = ("REM", "Core", "Deep", "awake")

# Column order of the wide table.
POP_AGG_COLUMNS = (
    "ID", "DATE", "AGE", "BLOODTYPE", "GENDER",
    "ACTIVE_ENERGY_BURNED", "APPLE_STAND_TIME", "BASAL_ENERGY_BURNED", "CARBS", "CHOLESTEROL",
    "DIETARY_ENERGY", "FATMONO", "FATPOLY", "FATSAT", "FATTOTAL", "FLIGHTSCLIMBED", "PROTEIN",
    "SODIUM", "STEPS", "SUGAR", "WALK_RUN", "EXERCISE_TIME", "BODYMASS", "SLEEP",
    "HEART_RATE_ARR", "REST_HEART_RATE_ARR", "SDNN_HEART_RATE_ARR", "WALK_HEART_RATE_ARR",
    "STAND_TIME_ARR", "ENVIRONMENT_AUDIO_ARR", "HEADPHONE_AUDIO_ARR", "FLIGHTS_ARR",
    "WALK_RUN_ARR", "STEPS_ARR", "ACTIVE_ENERGY_ARR", "BASAL_ARR", "WEEK_CALS_ARR",
    "EXERCISE_TIME_ARR", "SLEEP_ARR", "RUN_DATE",
)
