import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.catalogue import DAILY_SUMS
from pulsegrid.functions import clock, numbers, text
from pulsegrid.operators import extract, insights
from uploads import document, quantity, samples_of

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 8)
SCHEMA = "ID string, DATE date, AGE int, GENDER string, BLOODTYPE string, SLEEP bigint, " + ", ".join(
    f"{c} double" for c, _ in DAILY_SUMS) + ", PART int"


def trend(spark, *days):
    rows = []
    for user, date, values in days:
        rows.append((user, date, values.get("AGE", 34), "Female", "O+", values.get("SLEEP"),
                     *[values.get(c) for c, _ in DAILY_SUMS], 0))
    return spark.createDataFrame(rows, SCHEMA)


def test_kpis_skip_missing_days_and_truncate(spark):
    t = trend(
        spark,
        ("A", D1, {"AGE": 33, "BODYMASS": 180.9, "ACTIVE_ENERGY_BURNED": 500.0, "SLEEP": 400,
                   "BASAL_ENERGY_BURNED": 1500.0, "APPLE_STAND_TIME": 700.0}),
        ("A", D2, {"BODYMASS": 181.9, "ACTIVE_ENERGY_BURNED": 900.0, "SLEEP": 425}),
        ("B", D1, {}),
    )
    k = {r.ID: r for r in insights.kpis(t).collect()}
    a = k["A"]
    assert (a.AGE, a.WEIGHT, a.ACTIVE_ENERGY, a.CALS_BURNED, a.STAND_MINS) == (33, 181, 700, 2000, 11)
    assert a.SLEEP_HOURS == round(412.5 / 60, 2) and a.STEPS is None
    assert k["B"].WEIGHT is None and k["B"].SLEEP_HOURS is None


def test_nutrition_and_macros(spark):
    t = trend(spark, ("A", D1, {"PROTEIN": 2.5, "CARBS": 3.5, "FATTOTAL": 1.0, "SODIUM": 1.2349,
                                "BASAL_ENERGY_BURNED": 0.5, "ACTIVE_ENERGY_BURNED": 1.5}))
    assert insights.nutrition_kpis(t).first().SODIUM_MG == 1234
    m = insights.macro_calories(t).first()
    assert (m.date, m.Protein, m.Carbs, m.Fat) == (dt.date(2024, 1, 2), 8.0, 16.0, 9.0)
    b = insights.burned_calories(t).first()
    assert (b.Basal, b.Active) == (0.0, 2.0)
    long = insights.long_calories(insights.macro_calories(t)).collect()
    assert {r.variable: (r.monthdate, r.value) for r in long} == {
        "Protein": ("Jan 02", 0.0), "Carbs": ("Jan 02", 0.0), "Fat": ("Jan 02", 0.0)}
    assert insights.chart_ceiling(t).first().CEILING == 0.033


def balance(spark, end=D2, **values):
    t = trend(spark, ("A", D1, values))
    return insights.calorie_balance(t, D1, end).first()


def test_balance_floors_and_guards_division(spark):
    lose = balance(spark, BASAL_ENERGY_BURNED=7000.0)
    assert (lose.CAL_DIFF, lose.DIRECTION, lose.DAYS_PER_POUND) == (-7000, "lose", 4)
    gain = balance(spark, PROTEIN=700.0 * 7 / 4)
    assert (gain.DIRECTION, gain.DAYS_PER_POUND) == ("gain", 5)
    odd = balance(spark, BASAL_ENERGY_BURNED=7 * 1001.0)
    assert odd.DAYS_PER_POUND == abs(3500 // -1001)
    assert balance(spark, PROTEIN=1.0).DAYS_PER_POUND is None
    assert balance(spark, end=D1, PROTEIN=1000.0).DAYS_PER_POUND is None


def test_time_range_ends_at_midnight_unless_asked(spark):
    s = samples_of(spark, document("A", HeartRate=[
        quantity(60, "2024-01-02 15:00:00", unit="count/min", uuid="1"),
        quantity(90, "2024-01-08 05:00:00", unit="count/min", uuid="2"),  # midnight local
        quantity(99, "2024-01-08 15:00:00", unit="count/min", uuid="3")],
        RestingHeartRate=[quantity(1.1, "2024-01-03 15:00:00")]))
    k = insights.heart_kpis(s, D1, D2).first()
    assert (k.HEART_RATE, k.RESTING_HR, k.WALKING_HR) == (75, 66, None)
    assert insights.heart_kpis(s, D1, D2, include_end_day=True).first().HEART_RATE == 83
    hr = extract.fact(s, "HEARTRATE")
    points = insights.heart_points(hr, D1, D2)
    assert sorted((str(r.DATE), r.HR) for r in points.collect()) == [
        ("2024-01-03", 60), ("2024-01-09", 90)]
    r = insights.value_range(insights.heart_points(hr, D1, D2, True), "HR", "ID").first()
    assert (r.LOW, r.HIGH) == (60, 99)


def test_trend_ends_are_included(spark):
    t = trend(spark, ("A", D1, {}), ("A", D2, {}), ("A", dt.date(2024, 1, 9), {}), ("B", D1, {}))
    assert insights.trend(t, D1, D2).count() == 3
    assert insights.trend(t, D1, D2, "B").count() == 1


def test_meals_latest_and_day_total(spark):
    t1, t2 = "2024-01-05 17:00:00", "2024-01-05 18:30:00"
    s = samples_of(spark, document("A", DietaryEnergyConsumed=[
        quantity(100, t1, uuid="1"), quantity(50, t1, uuid="2"), quantity(0, t2, uuid="3")],
        StepCount=[quantity(7, t1, uuid="4"), quantity(9, t2, end="2024-01-05 19:00:00", uuid="5")]))
    meal = insights.meal_calories(extract.fact(s, "DIETARYENERGY")).collect()
    assert [(r.ID, str(r.DATE), r.TIME, r.CALS) for r in meal] == [
        ("A", "2024-01-05", "12:00:00", 150.0)]
    last = {r.METRIC: r.UUID for r in insights.latest_sample(s).collect()}
    assert last == {"DIETARYENERGY": "3", "STEPCOUNT": "5"}
    before = insights.latest_sample(s, dt.datetime(2024, 1, 5, 13, 45)).filter("METRIC='STEPCOUNT'")
    assert before.first().UUID == "4"
    assert insights.day_total(s, "STEPCOUNT", dt.date(2024, 1, 5)).first().VALUE == 16
    noon = dt.datetime(2024, 1, 5, 12, 30)
    assert insights.day_total(s, "STEPCOUNT", noon).first().VALUE == 7


def test_scalar_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first().v
    lit = F.lit
    assert one(numbers.half_even(lit(2.5))) == 2.0 and one(numbers.half_even(lit(3.5))) == 4.0
    assert one(numbers.truncate(lit(2.7))) == 2 and one(numbers.truncate(lit(-2.7))) == -2
    assert one(numbers.nearest_int(lit(2.5))) == 3
    assert one(numbers.floor_div(lit(-7), lit(2))) == -4
    assert one(numbers.floor_div(lit(7), lit(0))) is None
    assert one(numbers.text_or_empty(lit(None).cast("double"))) == ""
    born = lit(dt.date(2000, 2, 29))
    assert one(clock.age_on(born, lit(dt.date(2024, 2, 28)))) == 23
    assert one(clock.age_on(born, lit(dt.date(2024, 2, 29)))) == 24
    assert one(clock.month_day(lit(D1))) == "Jan 01"
    assert one(text.drop_utc_offset(lit("2024-01-01 00:00:00 +0000"))) == "2024-01-01 00:00:00"
    assert one(text.drop_quotes(lit("a'b\"c"))) == "abc"
    assert one(text.identity_zip(lit("U1|10001"))) == "10001"
    assert one(text.quantity_unit(lit("72 count/min"))) == "count/min"
    stamp = lambda s: clock.as_wall_clock(lit(s))
    assert one(clock.as_wall_clock(lit("2024-01-05 04:00:00 +0000"))) == dt.datetime(2024, 1, 5, 4)
    assert one(clock.as_wall_clock(lit("2024-01-05 01:00:00 +0230"))) == dt.datetime(2024, 1, 4, 22, 30)
    assert one(clock.as_wall_clock(lit("2024-01-05 01:00:00 -05:00"))) == dt.datetime(2024, 1, 5, 6)
    assert one(clock.minutes_crossed(stamp("2024-01-05 23:59:50"), stamp("2024-01-06 00:00:10"))) == 1
    assert one(clock.minute_start(stamp("2024-01-05 23:59:50"))) == dt.datetime(2024, 1, 5, 23, 59)
    assert one(clock.second_start(stamp("2024-01-05 23:59:50.7"))) == dt.datetime(2024, 1, 5, 23, 59, 50)


def test_range_questions_read_only_their_days(spark, tmp_path):
    from pulsegrid.operators import extract, sleep
    from pulsegrid.sources import tables
    from uploads import document, quantity, samples_of, stage

    rows = samples_of(spark, document(
        "A", HeartRate=[quantity(60, f"2024-01-0{d} 12:00:00", unit="count/min", uuid=str(d)) for d in range(1, 7)],
        SleepAnalysis=[stage(4, f"2024-01-0{d} 23:30:00", f"2024-01-0{d} 23:55:00", f"s{d}") for d in range(1, 7)]))
    stored = tables.store_samples(rows, str(tmp_path / "s"))
    start, end = dt.date(2024, 1, 3), dt.date(2024, 1, 4)
    rates = extract.fact(stored, "HEARTRATE", first_day=start, last_day=end)
    nights = extract.fact(stored, "SLEEP", first_day=start - dt.timedelta(days=1), last_day=end)
    for df, whole in (
        (insights.heart_points(rates, start, end), insights.heart_points(extract.fact(rows, "HEARTRATE"), start, end)),
        (sleep.sleep_timeline(nights, start, end), sleep.sleep_timeline(extract.fact(rows, "SLEEP"), start, end)),
    ):
        assert "PartitionFilters: [isnotnull(DAY" in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(df.collect()) == sorted(whole.collect()) and df.count()


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    gap = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-31 02:30:05' AS T")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        row = gap.select(clock.time_of_day(gap.T).alias("A"), clock.stamp(gap.T).alias("B")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == ("02:30:05", "2024-03-31 02:30:05")


def test_trend_has_one_row_a_day_unless_series_are_asked_for(spark):
    rows = spark.createDataFrame([("A", dt.date(2024, 1, 2), 0), ("A", dt.date(2024, 1, 1), 0),
                                  ("A", dt.date(2024, 1, 1), 1)], "ID string, DATE date, PART int")
    days = lambda **o: [(r.DATE.day, r.PART) for r in insights.trend(
        rows, dt.date(2024, 1, 1), dt.date(2024, 1, 2), id="A", **o).collect()]
    assert days() == [(1, 0), (2, 0)] and days(series=True) == [(1, 0), (1, 1), (2, 0)]
