import datetime as dt
import random

from pyspark.sql import functions as F

from pulsegrid.operators import history
from pulsegrid.sources.dimensions import Calendar

CAL = Calendar(dt.date(2024, 1, 1), 30)
ENERGY = "ID string, TIME date, CONSUMED double, ACTIVE_ENERGY double, BASAL_ENERGY double"


def energy(spark):
    rng = random.Random(2)
    rows = [
        (u, CAL.start + dt.timedelta(days=d), float(rng.randint(1, 9)), float(d), 2.0)
        for u in "AB" for d in range(-12, 34) if rng.random() < 0.4
    ]
    return rows, spark.createDataFrame(rows, ENERGY)


def expected(rows):
    out = {}
    for u in "AB":
        for n in range(CAL.days):
            day = CAL.start + dt.timedelta(days=n)
            data = sorted(
                (t, a, b, c) for i, t, c, a, b in rows
                if i == u and dt.timedelta(0) <= day - t <= dt.timedelta(days=9)
            )
            if data:
                out[u, day] = data
    return out


def shown(df):
    return {
        (r.ID, r.DATE): [(x.DATE.date(), x.ACTIVE, x.BASAL, x.CONSUMED) for x in r.DATA]
        for r in df.collect()
    }


def test_forward_and_window_forms_equal_the_range_condition(spark):
    rows, df = energy(spark)
    spine = spark.createDataFrame([("A",), ("B",)], "ID string").select(
        "ID", F.explode(CAL.dates()).alias("DATE"))
    want = expected(rows)
    assert shown(history.energy_history(df, CAL)) == want
    assert shown(history.energy_history_window(df, spine)) == want


def test_nine_days_back_counts_and_ten_does_not(spark):
    df = spark.createDataFrame([("A", CAL.start, 1.0, 2.0, 3.0)], ENERGY)
    days = {d for _, d in shown(history.energy_history(df, CAL))}
    assert days == {CAL.start + dt.timedelta(days=n) for n in range(10)}


def test_legacy_labels_and_incomplete_entries(spark):
    df = spark.createDataFrame(
        [("A", CAL.start, 1.0, 2.0, 3.0), ("A", CAL.start + dt.timedelta(1), None, 2.0, 3.0)],
        ENERGY)
    first = lambda **k: history.energy_history(df, CAL, **k).filter(
        F.col("DATE") == CAL.start + dt.timedelta(1)).first().DATA
    assert [(x.ACTIVE, x.BASAL, x.CONSUMED) for x in first()] == [(2.0, 3.0, 1.0)]
    assert [(x.ACTIVE, x.BASAL, x.CONSUMED) for x in first(legacy_labels=True)] == [(1.0, 2.0, 3.0)]
