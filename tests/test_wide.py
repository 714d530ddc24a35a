import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.catalogue import DAILY_SUMS, FACTS, HOURLY_SUMS, POP_AGG_COLUMNS
from pulsegrid.operators import extract, history, population, rollup, series, sleep
from pulsegrid.plans import wide
from pulsegrid.sources.dimensions import Calendar
from pulsegrid.sources.documents import parse_documents
from uploads import document, quantity, records, stage

CAL = Calendar(dt.date(2024, 1, 1), 12)
RUN = dt.datetime(2024, 2, 1)


def uploads(users="AB", n=6):
    rng = random.Random(9)
    docs = [document("NONE")]
    for user in users:
        arrays = {}
        for m in FACTS:
            at = lambda h: f"2024-01-{rng.randint(2, 9):02d} {h:02d}:{rng.randint(0, 59):02d}:00"
            if m.key == "SleepAnalysis":
                arrays[m.key] = [
                    stage(rng.randint(0, 5), t, t[:11] + "09:30:00", f"{user}{i}")
                    for i, t in ((i, at(8)) for i in range(n))
                ]
            else:
                arrays[m.key] = [
                    quantity(rng.randint(1, 50), at(rng.randint(0, 23)), uuid=f"{user}{m.key}{i}")
                    for i in range(n)
                ]
        docs.append(document(user, **arrays))
    return docs


def build(spark, docs, **options):
    parsed = parse_documents(records(spark, *docs))
    samples = extract.samples(parsed).persist()
    pop = population.population(parsed)
    return samples, pop, wide.pop_agg(samples, pop, CAL, F.lit(RUN), **options)


def rows_of(df):
    return sorted(df.collect(), key=lambda r: (r.ID, r.DATE, r.PART, repr(r)))


def test_shape_and_user_without_samples(spark):
    _, _, agg = build(spark, uploads())
    assert agg.columns == [*POP_AGG_COLUMNS, "PART"] and len(POP_AGG_COLUMNS) == 40
    rows = rows_of(agg)
    assert len(rows) == 3 * CAL.days
    none = [r for r in rows if r.ID == "NONE"]
    assert len(none) == CAL.days
    for r in none:
        assert all(r[c] is None for c, _ in DAILY_SUMS) and r.SLEEP is None
        assert r.SLEEP_ARR is None and r.WEEK_CALS_ARR is None and r.REST_HEART_RATE_ARR is None
        for c, _ in HOURLY_SUMS:
            assert [x.val for x in r[c]] == [0.0] * 24
            assert [x.DATE.hour for x in r[c]] == list(range(24))
        assert [x.val for x in r.HEART_RATE_ARR] == [""] * 24
        assert r.AGE == 34 and r.RUN_DATE == RUN


def test_columns_equal_the_operators_one_by_one(spark):
    samples, pop, agg = build(spark, uploads())
    rows = {(r.ID, r.DATE): r for r in agg.collect()}
    spine = population.day_spine(pop, CAL)
    for r in rollup.daily_wide_joins(samples, spine).collect():
        assert [rows[r.ID, r.DATE][c] for c, _ in DAILY_SUMS] == [r[c] for c, _ in DAILY_SUMS]
    for column, fact_name in HOURLY_SUMS:
        for r in rollup.hourly_series(extract.fact(samples, fact_name), spine).collect():
            assert rows[r.ID, r.DATE][column] == r.DATA
    for column, fact_name in series.RAW_SERIES:
        want = {(r.ID, r.DATE): r.DATA for r in series.raw_series(samples, fact_name).collect()}
        assert {k: r[column] for k, r in rows.items() if r[column]} == want
    for r in series.hourly_distinct(samples, spine).collect():
        assert rows[r.ID, r.DATE].HEART_RATE_ARR == r.DATA
    nights = extract.sleep_fact(samples)
    want = {(r.ID, r.DATE): r.SLEEP for r in sleep.sleep_nightly(nights).collect()}
    assert {k: r.SLEEP for k, r in rows.items() if r.SLEEP is not None} == want
    want = {(r.ID, r.DATE): r.DATA for r in sleep.sleep_segments(nights).collect()}
    assert {k: r.SLEEP_ARR for k, r in rows.items() if r.SLEEP_ARR} == {
        k: v for k, v in want.items() if v}
    energy = history.daily_energy(samples)
    want = {(r.ID, r.DATE): r.DATA for r in history.energy_history(energy, CAL).collect()}
    assert {k: r.WEEK_CALS_ARR for k, r in rows.items() if r.WEEK_CALS_ARR} == want


def test_stored_user_days_change_nothing(spark):
    samples, pop, agg = build(spark, uploads())
    days = rollup.user_days(wide.samples_between(samples, CAL))
    assert rows_of(wide.pop_agg(samples, pop, CAL, F.lit(RUN), days=days)) == rows_of(agg)


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_results_do_not_depend_on_the_session_zone(spark, zone):
    t = "2024-03-10 10:30:00"  # inside the hour the zone skips
    docs = uploads() + [document("A", StepCount=[quantity(5, t)])]
    want = rows_of(build(spark, docs)[2])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert rows_of(build(spark, docs)[2]) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_two_units_on_a_day_give_two_rows(spark):
    t = "2024-01-05 12:00:00"
    docs = [document("A", BodyMass=[quantity(180, t, unit="lb"), quantity(82, t, unit="kg")],
                     StepCount=[quantity(5, t)],
                     EnvironmentalAudioExposure=[quantity(i, t, uuid=str(i)) for i in range(9)])]
    rows = rows_of(build(spark, docs)[2])
    day = [r for r in rows if r.DATE == dt.date(2024, 1, 5)]
    assert sorted(r.BODYMASS for r in day) == [82.0, 180.0]
    assert all(r.STEPS == 5.0 and sum(x.val for x in r.STEPS_ARR) == 5.0 for r in day)
    assert len(rows) == CAL.days + 1
    parts = [r for r in rows_of(build(spark, docs, part_items=3)[2]) if r.DATE == day[0].DATE]
    assert [r.PART for r in parts] == [0, 0, 1, 2]
    assert [r.BODYMASS for r in parts[2:]] == [None, None]


def test_long_day_continues_in_further_rows(spark):
    docs = uploads("A", n=40)
    _, _, agg = build(spark, docs)
    _, _, cut = build(spark, docs, part_items=4)
    assert cut.filter("PART > 0").count() > 0
    whole = {(r.ID, r.DATE): r for r in agg.collect()}
    first = {(r.ID, r.DATE): r for r in cut.filter("PART = 0").collect()}
    lists = [series.HEART_RATE_SERIES, *[c for c, _ in series.RAW_SERIES]]
    assert set(first) == set(whole)
    for k, r in whole.items():
        for c in POP_AGG_COLUMNS:
            if c not in lists:
                assert first[k][c] == r[c]
    for c in lists:
        joined = {}
        for r in rows_of(cut):
            joined.setdefault((r.ID, r.DATE), []).extend(r[c] or [])
        for k, r in whole.items():
            assert [x.DATE for x in joined[k]] == [x.DATE for x in r[c] or []]
            assert sorted(map(tuple, joined[k])) == sorted(map(tuple, r[c] or []))
    sums = [c for c, _ in DAILY_SUMS] + ["SLEEP"]
    assert all(r[c] is None for r in cut.filter("PART > 0").collect() for c in sums)


def test_samples_are_read_by_day_range(spark, tmp_path):
    from pulsegrid.sources import tables

    samples, pop, _ = build(spark, uploads())
    stored = tables.store_samples(samples, str(tmp_path / "s"))
    cal = Calendar(dt.date(2024, 1, 4), 2)
    plan = rollup.user_days(wide.samples_between(stored, cal))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "PartitionFilters: [isnotnull(DAY" in text and "PushedFilters: [IsNotNull(ID), In(METRIC" in text
    for unused in ("UUID", "ENDTIME", "FOODTYPE"):
        assert unused not in text.split("ReadSchema")[1]
    assert "BatchEvalPython" not in text and "CartesianProduct" not in text
