import json

from pulsegrid.sources import documents as D
from uploads import document, quantity, records

WORKOUT = "{'activity':'run','Duration':10}{'activity':'run','Duration':12}"


def ids(df):
    return sorted(r.ID for r in D.parse_documents(df).collect())


def write(folder, name, content):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(content)


def test_documents_without_separator_and_workout_text(spark, tmp_path):
    docs = [document(f"U{i}", Activities=[WORKOUT]) for i in range(5)]
    write(tmp_path / "in", "a.json", "".join(docs))
    df = D.read_documents(spark, str(tmp_path / "in"))
    assert sorted(json.loads(r.record)["identifier"] for r in df.collect()) == [
        f"U{i}" for i in range(5)
    ]
    assert all(json.loads(r.record)["Activities"] == [WORKOUT] for r in df.collect())


def test_envelopes_bare_documents_and_white_space_mixed(spark, tmp_path):
    wrap = lambda d: f'{{"body":{d}}}'
    a, b, c, d, e = (document(f"U{i}") for i in range(5))
    write(tmp_path / "in", "a.json", wrap(a) + wrap(b) + c + "\n" + wrap(d) + " \n " + e + "\n")
    write(tmp_path / "in", "b.json", wrap(document("U9")))
    write(tmp_path / "in", "empty.json", "")
    df = D.read_documents(spark, str(tmp_path / "in"))
    assert ids(df) == ["U0", "U1", "U2", "U3", "U4", "U9"]
    assert all(set(json.loads(r.record)) >= {"identifier", "zip"} for r in df.collect())


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    docs = [document(f"U{i}", StepCount=[quantity(i, "2024-01-05 04:10:00")]) for i in range(400)]
    write(tmp_path / "in", "a.json", "".join(docs))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        df = D.read_documents(spark, str(tmp_path / "in"))
        assert df.rdd.getNumPartitions() > 5
        assert ids(df) == sorted(f"U{i}" for i in range(400))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_split_on_one_text(spark):
    text = document("A", Activities=[WORKOUT]) + document("B") + "\n" + document("C")
    df = spark.createDataFrame([(text,)], "value string")
    assert ids(D.frame(df)) == ["A", "B", "C"]


def test_long_metric_names_are_shortened(spark):
    raw = document("A").replace(
        '"zip"', '"HKQuantityTypeIdentifierStepCount": ["{}"], '
        '"HKCategoryTypeIdentifierSleepAnalysis": [], "zip"'
    )
    row = D.frame(spark.createDataFrame([(raw,)], "value string")).first()
    assert {"StepCount", "SleepAnalysis"} <= set(json.loads(row.record))


def test_profile_fields_and_bad_values(spark):
    df = D.parse_documents(records(spark, document("A", age="x", loaddate="soon"), "not json"))
    rows = {r.ID: r for r in df.collect()}
    assert rows["A"].AGE is None and rows["A"].LOADTIME is None
    assert rows["A"].GENDER == "Female"
    assert None in rows


def test_only_the_needed_fields_are_parsed(spark):
    df = D.parse_documents(records(spark, document("A"))).select("ID", "LOADTIME")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "StepCount" not in plan
