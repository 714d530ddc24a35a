import datetime as dt

from pulsegrid.catalogue import FACTS, FOOD, MEASURE
from pulsegrid.operators import extract
from pulsegrid.sources.documents import parse_documents
from uploads import document, quantity, records, samples_of, stage


def at(text):
    return dt.datetime.fromisoformat(text)


def test_repeated_uploads_collapse_and_other_uuid_stays(spark):
    a = quantity(10, "2024-01-05 04:10:00", uuid="a")
    b = quantity(10, "2024-01-05 04:10:00", uuid="b")
    s = samples_of(
        spark,
        document(StepCount=[a], BodyMass=[a, b]),
        document(StepCount=[a, b], BodyMass=[a], loaddate="2024-01-06 04:00:00 +0000"),
    )
    assert extract.fact(s, "STEPCOUNT").count() == 2
    body = extract.fact(s, "BODYMASS").collect()
    assert len(body) == 1 and body[0].UUID is None


def test_missing_empty_and_malformed(spark):
    s = samples_of(
        spark,
        document("A"),
        document("B", StepCount=[], HeartRate=["no sample"]),
        document("C", StepCount=["{'value': 'x', 'start_time': 'never', 'unit': 'count'}"]),
    )
    assert s.filter("ID = 'A'").count() == 0
    rows = {(r.ID, r.METRIC): r for r in s.collect()}
    assert rows["B", "HEARTRATE"].VALUE is None and rows["B", "HEARTRATE"].STARTTIME is None
    assert rows["C", "STEPCOUNT"].VALUE is None and rows["C", "STEPCOUNT"].STARTTIME is None
    assert ("B", "STEPCOUNT") not in rows


def test_daylight_saving(spark):
    starts = ["2024-03-10 06:59:59", "2024-03-10 07:00:00",
              "2024-11-03 05:30:00", "2024-11-03 06:30:00"]
    s = samples_of(
        spark,
        document(StepCount=[quantity(1, t, uuid=str(i)) for i, t in enumerate(starts)]),
    )
    local = {r.UUID: r.STARTTIME for r in s.collect()}
    assert local["0"] == at("2024-03-10 01:59:59")
    assert local["1"] == at("2024-03-10 03:00:00")
    assert local["2"] == local["3"] == at("2024-11-03 01:30:00")


def test_basal_energy_keeps_utc(spark):
    q = quantity(5, "2024-01-05 02:00:00", unit="Cal")
    s = samples_of(spark, document(BasalEnergyBurned=[q], ActiveEnergyBurned=[q]))
    days = {r.METRIC: r.DAY for r in s.collect()}
    assert days["BASALENERGYBURNED"] == dt.date(2024, 1, 5)
    assert days["ACTIVE_ENERGY_BURNED"] == dt.date(2024, 1, 4)


def test_heart_rate_unit(spark):
    t = "2024-01-05 12:00:00"
    s = samples_of(
        spark,
        document(HeartRate=[quantity(1.5, t, unit="count/s", uuid="s"),
                            quantity(80, t, unit="count/min", uuid="m")],
                 RestingHeartRate=[quantity(1.1, t, unit="count/s")]),
    )
    hr = {r.UUID: (r.VALUE, r.UNIT) for r in extract.fact(s, "HEARTRATE").collect()}
    assert hr == {"s": (90.0, "count/s"), "m": (80.0, "count/min")}
    assert extract.fact(s, "RESTINGHEARTRATE").first().VALUE == 1.1


def test_food_columns_by_name_and_by_legacy_position(spark):
    t = "2024-01-05 12:00:00"
    s = samples_of(spark, document(DietaryCarbohydrates=[
        quantity(20, t, unit="g", uuid="x", meal="Lunch"), quantity(3, t, unit="g", uuid="y")]))
    food = {r.UUID: r for r in extract.fact(s, "CARBS").collect()}
    x = food["x"]
    assert (x.FOODIMAGENAME, x.FOODMEAL, x.FOODTYPE, x.FOODUSDANUMBER) == (
        "Egg", "Lunch", "Egg dish", "1123")
    assert food["y"].FOODMEAL is None
    old = {r.UUID: r for r in extract.fact(s, "CARBS", legacy_positions=True).collect()}["x"]
    assert (old.FOODMEAL, old.FOODTYPE, old.FOODTYPEUUID, old.FOODUSDANUMBER) == (
        "Egg dish", "1123", None, "Lunch")
    assert len(extract.fact(s, "CARBS").columns) == 14


def test_sleep_rules(spark):
    s = samples_of(spark, document(SleepAnalysis=[
        stage(4, "2024-01-05 03:59:50", "2024-01-05 04:00:10", "short"),
        stage(9, "2024-01-05 05:00:00", "2024-01-05 05:10:00", "odd"),
        stage(3, "2024-01-05 06:00:00", "2024-01-05 06:30:00", "phone", "iPhone14,2"),
        stage(0, "2024-01-05 07:00:00", "2024-01-05 07:30:00", "bed", "WATCH7"),
    ]))
    rows = {r.UUID: r for r in extract.sleep_fact(s).collect()}
    assert set(rows) == {"short", "odd", "bed"}
    assert (rows["short"].CYCLE, rows["short"].MINS, rows["short"].UNIT) == ("Deep", 1, "Sleep")
    assert rows["odd"].CYCLE is None and rows["odd"].MINS == 10
    assert rows["bed"].CYCLE == "InBed"


def test_one_scan_equals_one_scan_per_fact(spark):
    t = "2024-01-05 12:00:00"
    arrays = {m.key: [quantity(i + 1, t, uuid=m.fact, meal="Lunch")] for i, m in enumerate(FACTS)}
    recs = records(spark, document(**arrays))
    docs = parse_documents(recs)
    long = extract.samples(docs)
    assert {r.METRIC: r["count"] for r in long.groupBy("METRIC").count().collect()} == {
        m.fact: 1 for m in FACTS}
    for m in FACTS[3::5]:
        one, many = extract.fact(long, m.fact), extract.extract_metric(docs, m.fact)
        assert one.columns == many.columns
        assert one.collect() == many.collect()
    assert extract.facts(long, MEASURE).select("METRIC").distinct().count() == 12
    assert extract.facts(long, FOOD).select("METRIC").distinct().count() == 12


def test_elements_are_parsed_once(spark):
    docs = parse_documents(records(spark, document()))
    plan = extract.samples(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2  # the document, then the element


def test_legacy_weight(spark):
    text = ('172.5 lb 1A-2B \\"Health App\\" (1.0), iPhone14,2 (15.4) metadata: { entered = 1; '
            'external X-9 (2020-02-03 11:12:13 +0000 - 2020-02-03 11:12:13 +0000)')
    raw = '{"identifier":"U","BodyMass":["%s", "short text"]}' % text
    rows = extract.legacy_weight(records(spark, raw)).collect()
    r = [x for x in rows if x.VALUE is not None][0]
    assert (r.VALUE, r.UNIT, r.UUID, r.APP, r.DEVICE, r.EXTERNALUUID) == (
        172.5, "lb", "1A-2B", '"Health App"', "iPhone14,2", "X-9")
    assert r.DATE == at("2020-02-03 11:12:13")
    other = [x for x in rows if x.VALUE is None][0]
    assert other.DATE is None and other.UNIT == "text"
