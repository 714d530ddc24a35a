import datetime as dt
import math
import random

import pytest

from pulsegrid.operators import extract, sleep
from uploads import document, samples_of, stage

NIGHT = "ID string, DATE date, DATA array<struct<DATE: timestamp_ntz, val: double, cycle: string>>"
DAY = dt.date(2024, 1, 5)
COUNTED = ("REM", "Core", "Deep", "awake")


def minute_by_minute(data, keep_tail):
    """Walk through a night one minute at a time."""
    if not data:
        return None
    start = data[0][0]
    minutes = [c for _, v, c in data for _ in range(int(v))]
    hours = math.ceil(len(minutes) / 60)
    if keep_tail and minutes:
        hours = math.ceil((start.minute + len(minutes)) / 60)
    first = start.replace(minute=0)
    cells = {(first + dt.timedelta(hours=h), c): 0 for h in range(hours) for c in COUNTED}
    for i, cycle in enumerate(minutes):
        key = ((start + dt.timedelta(minutes=i)).replace(minute=0), cycle)
        if key in cells:
            cells[key] += 1
    return [(t, c, v) for (t, c), v in cells.items()]


def nights(n):
    rng = random.Random(11)
    out = [("none", DAY, None), ("empty", DAY, []),
           ("late", DAY, [(dt.datetime(2024, 1, 4, 23, 30), 50.0, "Deep")]),
           ("zero", DAY, [(dt.datetime(2024, 1, 4, 23, 30), 0.0, "Deep")])]
    for i in range(n):
        t = dt.datetime(2024, 1, 4, 22, rng.randint(0, 59))
        data = []
        for _ in range(rng.randint(1, 12)):
            v = rng.choice([0, 1, 7, 20, 59, 60, 61, 130])
            data.append((t, float(v), rng.choice(COUNTED + ("Unknown",))))
            t += dt.timedelta(minutes=v + rng.choice([0, 0, 13]))
        out.append((f"n{i}", DAY, data))
    return out


@pytest.mark.parametrize("keep_tail", [False, True])
def test_normalised_night_equals_minute_walk(spark, keep_tail):
    rows = nights(60)
    got = sleep.normalise_sleep(spark.createDataFrame(rows, NIGHT), keep_tail=keep_tail)
    result = {
        r.ID: None if r.DATA is None else [(x.DATE, x.cycle, x.val) for x in r.DATA]
        for r in got.collect()
    }
    assert len(result) == len(rows)
    for night, _, data in rows:
        assert result[night] == minute_by_minute(data, keep_tail), night


def test_tail_minutes(spark):
    df = spark.createDataFrame([r for r in nights(0) if r[0] == "late"], NIGHT)
    total = lambda k: sum(x.val for x in sleep.normalise_sleep(df, keep_tail=k).first().DATA)
    assert (total(False), total(True)) == (30, 50)


def sleep_of(spark, *stages, user="U1"):
    return extract.sleep_fact(samples_of(spark, document(user, SleepAnalysis=list(stages))))


def test_the_day_turns_at_six_in_the_evening(spark):
    # 22:59 and 23:00 UTC are 17:59 and 18:00 in New York
    s = sleep_of(spark,
                 stage(3, "2024-01-05 22:59:00", "2024-01-05 23:19:00", "a"),
                 stage(4, "2024-01-05 23:00:00", "2024-01-05 23:10:00", "b"))
    got = {str(r.DATE): r.SLEEP for r in sleep.sleep_nightly(s).collect()}
    assert got == {"2024-01-05": 20, "2024-01-06": 10}
    first = sleep.sleep_segments(s).filter("DATE = '2024-01-06'").first().DATA[0]
    assert str(first.DATE) == "2024-01-05 18:00:00"


def test_segments_and_nightly_use_different_stages(spark):
    t = "2024-01-05 0{}:00:30"
    s = sleep_of(spark, *[
        stage(v, t.format(4 + i), f"2024-01-05 0{4 + i}:10:30", f"s{v}")
        for i, v in enumerate([0, 1, 2, 5, 9])
    ])
    day = sleep.sleep_days(s).first()
    assert day.SLEEP == 10
    assert [(x.cycle, x.val) for x in day.SLEEP_ARR] == [
        ("Unknown", 10.0), ("awake", 10.0), ("REM", 10.0)]
    assert sleep.sleep_segments(s).first().DATA == day.SLEEP_ARR


def test_strip_numbers_every_minute(spark):
    s = sleep_of(spark,
                 stage(3, "2024-01-05 04:00:00", "2024-01-05 04:05:00", "a"),
                 stage(2, "2024-01-05 04:05:00", "2024-01-05 04:07:00", "b"),
                 stage(5, "2024-01-05 04:09:00", "2024-01-05 04:09:20", "c"),
                 stage(5, "2024-01-05 05:09:00", "2024-01-05 05:12:00", "d"))
    line = sleep.sleep_timeline(s, DAY, DAY)
    rows = sorted((r.X, r.Cat) for r in sleep.sleep_strip(line).collect())
    assert rows == list(enumerate(["Core"] * 5 + ["awake"] * 2 + ["REM"] * 3, start=1))
    assert sleep.sleep_timeline(s, DAY + dt.timedelta(1), DAY + dt.timedelta(9)).count() == 0
