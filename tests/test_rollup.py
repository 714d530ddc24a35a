import datetime as dt
import random

from pyspark.sql import functions as F

from pulsegrid.catalogue import DAILY_SUMS
from pulsegrid.operators import extract, population, rollup
from pulsegrid.sources.dimensions import Calendar, date_dim, hour_dim
from pulsegrid.sources.documents import parse_documents
from uploads import document, quantity, records, samples_of

CAL = Calendar(dt.date(2024, 1, 1), 10)


def population_of(spark, *docs):
    return population.population(parse_documents(records(spark, *docs)))


def test_latest_profile_and_ties(spark):
    pop = population_of(
        spark,
        document("A", age=30, loaddate="2024-01-05 04:00:00 +0000"),
        document("A", age=31, loaddate="2024-02-05 04:00:00 +0000"),
        document("A", age=31, loaddate="2024-02-05 04:00:00 +0000"),
        document("B", age=40), document("B", age=41), document("B", age=40),
    )
    assert sorted((r.ID, r.AGE) for r in pop.collect()) == [("A", 31), ("B", 40), ("B", 41)]
    assert population.day_spine(pop, CAL).count() == 20
    assert population.hour_spine(pop, CAL).count() == 480
    assert population.profiled_spine(pop, CAL).count() == 30


def test_spines_use_no_join(spark):
    pop = population_of(spark, document("A"))
    plan = population.hour_spine(pop, CAL)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_dimensions(spark):
    dates = date_dim(spark)
    assert dates.count() == 1830
    assert str(dates.agg(F.max("DATE")).first()[0]) == "2025-01-03"
    sunday = dates.filter("DATE = '2024-01-07'").first()
    assert (sunday.DAY_OF_WEEK, sunday.WEEK_OF_YEAR, sunday.MONTH_NAME, sunday.DAY_OF_YEAR) == (
        "1", 1, "Jan", 7)
    hours = hour_dim(spark)
    assert hours.count() == 43920
    assert hours.filter("DATE = timestamp_ntz'2024-01-07 13:00:00'").first().HOUR == 13
    assert dates.columns == ["DATE", "YEAR", "MONTH", "MONTH_NAME", "DAY_OF_MON", "DAY_OF_WEEK",
                             "WEEK_OF_YEAR", "DAY_OF_YEAR"]


def many_samples(spark):
    rng = random.Random(3)
    keys = {"StepCount": "count", "ActiveEnergyBurned": "Cal", "BodyMass": "lb",
            "DietarySugar": "g"}
    docs = []
    for user in "AB":
        arrays = {
            k: [quantity(rng.randint(1, 99), f"2024-01-{rng.randint(1, 9):02d} {rng.randint(0, 23):02d}:10:00",
                         unit=u, uuid=f"{user}{k}{i}") for i in range(30)]
            for k, u in keys.items()
        }
        docs.append(document(user, **arrays))
    docs.append(document("C"))
    return samples_of(spark, *docs), population_of(spark, *docs)


def test_pivot_equals_joins(spark):
    s, pop = many_samples(spark)
    spine = population.day_spine(pop, CAL)
    order = lambda df: sorted(df.collect(), key=lambda r: (r.ID, r.DATE))
    pivot, joins = order(rollup.daily_wide(s, spine)), order(rollup.daily_wide_joins(s, spine))
    assert pivot == joins and len(pivot) == 30
    assert all(r[c] is None for r in pivot if r.ID == "C" for c, _ in DAILY_SUMS)


def test_two_units_on_a_day_are_reported_and_duplicate_the_joined_row(spark):
    t = "2024-01-05 12:00:00"
    docs = [document("A", BodyMass=[quantity(180, t, unit="lb"), quantity(82, t, unit="kg")],
                     StepCount=[quantity(5, t)])]
    s, pop = samples_of(spark, *docs), population_of(spark, *docs)
    mixed = rollup.mixed_units(s).collect()
    assert [(r.ID, r.METRIC, r.FIRST_UNIT, r.LAST_UNIT) for r in mixed] == [
        ("A", "BODYMASS", "kg", "lb")]
    joined = rollup.daily_wide_joins(s, population.day_spine(pop, CAL)).filter("BODYMASS > 0")
    assert sorted(r.BODYMASS for r in joined.collect()) == [82.0, 180.0]


def test_two_weighings_are_summed(spark):
    s = samples_of(spark, document(BodyMass=[
        quantity(180, "2024-01-05 12:00:00", unit="lb"),
        quantity(181, "2024-01-05 13:00:00", unit="lb")]))
    assert rollup.daily_sum(extract.fact(s, "BODYMASS")).first().VALUE == 361
    assert rollup.daily_totals(s).first().BODYMASS == 361
    assert rollup.daily_totals(s, averaged=("BODYMASS",)).first().BODYMASS == 180.5


def test_hourly_forms_agree(spark):
    s, pop = many_samples(spark)
    steps = extract.fact(s, "STEPCOUNT")
    arrays = rollup.hourly_series(steps, population.day_spine(pop, CAL))
    rows = arrays.select("ID", F.inline("DATA")).collect()
    flat = rollup.hourly_fill(steps, population.hour_spine(pop, CAL)).collect()
    assert sorted((r.ID, r.DATE, r.val) for r in rows) == sorted(
        (r.ID, r.DATE, r.VALUE) for r in flat)
    assert all(len(r.DATA) == 24 for r in arrays.collect())
    assert all(x.val == 0 for r in arrays.filter("ID = 'C'").collect() for x in r.DATA)
