import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import population, series
from pulsegrid.sources.dimensions import Calendar
from uploads import document, quantity, samples_of

CAL = Calendar(dt.date(2024, 1, 4), 3)


def busy_day(spark, n=500):
    """One user's day holds nearly all samples, and one second of it holds a third of them."""
    rng = random.Random(5)
    second = lambda: f"2024-01-05 {rng.randint(6, 20):02d}:{rng.randint(0, 59):02d}:{rng.randint(0, 59):02d}"
    hot = [quantity(i % 7, "2024-01-05 12:00:00" if i % 3 == 0 else second(), uuid=f"h{i}")
           for i in range(n)]
    calm = [quantity(1.5, second(), uuid=f"c{i}") for i in range(4)]
    return samples_of(
        spark,
        document("HOT", EnvironmentalAudioExposure=hot, HeartRate=hot),
        document("CALM", EnvironmentalAudioExposure=calm, RestingHeartRate=calm[:2]),
    ).persist()


def expected(samples, metric):
    rows = samples.filter(F.col("METRIC") == metric).collect()
    out = {}
    for r in rows:
        out.setdefault(r.ID, []).append((r.STARTTIME, r.VALUE))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("broadcast", [10 << 20, -1])
def test_long_day_is_cut_into_ordered_parts_that_hold_everything(spark, broadcast):
    s = busy_day(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        points = series.number_parts(series.raw_points(s), 40).persist()
        points.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sizes = points.groupBy("ID", "DATE", "SERIES", "PART").count().collect()
    assert max(r["count"] for r in sizes) <= 80
    assert {r.PART for r in sizes if r.ID == "CALM"} == {0}
    parts = {r.PART for r in sizes if r.ID == "HOT"}
    assert parts == set(range(len(parts))) and len(parts) > 5
    per_part = {}
    for r in points.filter("ID = 'HOT'").collect():
        per_part.setdefault(r.PART, []).append((r["T"], r.V))
    times = [t for p in sorted(per_part) for t, _ in sorted(per_part[p])]
    assert times == sorted(times)
    whole = sorted(x for p in per_part.values() for x in p)
    assert whole == expected(s, "ENVIRONMENTAUDIO")["HOT"]


def test_raw_series_in_parts_and_whole(spark):
    s = busy_day(spark)
    want = expected(s, "ENVIRONMENTAUDIO")
    whole = {r.ID: r for r in series.raw_series(s, "ENVIRONMENTAUDIO").collect()}
    assert {i: [(x.DATE, x.val) for x in r.DATA] for i, r in whole.items()} == want
    cut = series.raw_series(s, "ENVIRONMENTAUDIO", part_items=40).filter("ID = 'HOT'")
    joined = [(x.DATE, x.val) for r in sorted(cut.collect(), key=lambda r: r.PART) for x in r.DATA]
    assert sorted(joined) == want["HOT"]
    assert [t for t, _ in joined] == [t for t, _ in want["HOT"]]


def test_heart_rate_is_distinct_per_hour_with_empty_hours(spark):
    s = busy_day(spark)
    pop = spark.createDataFrame([("HOT",), ("NONE",)], "ID string")
    spine = population.day_spine(pop, CAL)
    rows = {(r.ID, str(r.DATE)): r.DATA for r in series.hourly_distinct(s, spine).collect()}
    assert len(rows) == 6
    for key, data in rows.items():
        assert len({x.DATE for x in data}) == 24
    empty = rows["NONE", "2024-01-05"]
    assert [x.val for x in empty] == [""] * 24
    local = {}
    for t, v in expected(s, "HEARTRATE")["HOT"]:
        local.setdefault(t.replace(minute=0, second=0), set()).add(str(v))
    for x in rows["HOT", "2024-01-05"]:
        assert x.val in local.get(x.DATE, {""})
    assert len(rows["HOT", "2024-01-05"]) == sum(map(len, local.values())) + 24 - len(local)


def test_samples_without_value_are_left_out(spark):
    s = samples_of(spark, document(RestingHeartRate=[
        "{'unit': 'count/s', 'start_time': '2024-01-05 12:00:00'}",
        quantity(1.1, "2024-01-05 13:00:00")]))
    assert [len(r.DATA) for r in series.raw_series(s, "RESTINGHEARTRATE").collect()] == [1]
