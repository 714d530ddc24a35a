"""What large inputs need: documents parsed once, slices of bounded size, text made once a row."""

import datetime as dt

from pyspark.sql import functions as F

from checks import registered
from pulsegrid.catalogue import HOURLY_SUMS
from pulsegrid.functions import clock
from pulsegrid.operators import extract, population, sizing
from pulsegrid.plans import refresh, wide
from pulsegrid.schema import RECORD
from pulsegrid.sources import documents, levels, tables
from pulsegrid.sources.dimensions import Calendar
from pulsegrid.sources.documents import parse_documents
from uploads import document, quantity, records

DAY = "2024-01-05"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def empty_text(tail):
    return ";".join(f"{DAY} {h:02d}:00:00={tail}" for h in range(24))


def test_profiles_parse_each_document_once(spark):
    nameless = document("X").replace('"identifier"', '"nobody"')
    found = population.population(parse_documents(records(spark, document("A"), nameless, document("A"))))
    assert plan_of(found).count("from_json") == 1
    assert [r.ID for r in found.collect()] == ["A"]


def test_files_of_a_month_follow_its_days(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(wide, "WIDE_ROWS_PER_FILE", 100)
    docs = parse_documents(records(spark, *[document(f"U{n}") for n in range(30)]))
    calendar = Calendar(dt.date(2023, 12, 31), 40)
    df = wide.pop_agg(extract.samples(docs), population.population(docs), calendar, F.lit(0), by_month=True)
    stored = wide.store_pop_agg(df, str(tmp_path / "p"))
    files = stored.groupBy("MONTH", F.input_file_name().alias("F")).agg(
        F.count("*").alias("N"), F.countDistinct("ID").alias("USERS"))
    by_month = files.groupBy("MONTH").agg(F.sum("N").alias("N"), F.sum("USERS").alias("USERS"), F.count("*").alias("FILES"))
    got = {r.MONTH.month: (r.N, r.USERS, r.FILES) for r in by_month.collect()}
    assert {m: x[:2] for m, x in got.items()} == {12: (30, 30), 1: (930, 30), 2: (240, 30)}  # a user is in one file
    assert got[12][2] == 1 and got[2][2] <= 3 and got[1][2] > 4  # as many in each month would be four


def test_stamps_of_hours(spark):
    days = spark.createDataFrame([(dt.date(2024, 3, 10),), (dt.date(1, 1, 1),), (dt.date(9999, 12, 31),)], "DATE date")
    one_by_one = F.transform(clock.hours_of(F.col("DATE")), clock.stamp)
    for r in days.select(clock.hour_stamps(F.col("DATE")).alias("A"), one_by_one.alias("B")).collect():
        assert r.A == r.B and len(r.A) == 24


def test_text_of_arrays(spark):
    docs = parse_documents(records(spark, document("A", StepCount=[
        quantity(1.239, f"{DAY} 17:10:00", uuid="1"), quantity(2, f"{DAY} 18:59:59", uuid="2")]), document("B")))
    samples = extract.samples(docs)
    calendar = Calendar(dt.date(2024, 1, 5), 1)
    table = wide.pop_agg(samples, population.population(docs), calendar, F.lit(0)).localCheckpoint()
    text = registered._pop_agg_text(table)
    plan = plan_of(text.select("HEART_RATE_ARR", "STEPS_ARR", "FLIGHTS_ARR"))
    assert plan.count("AS ZEROS_TEXT") == plan.count("AS BLANKS_TEXT") == 1  # once a row, not once an array
    a, b = sorted(text.collect(), key=lambda r: r.ID)
    assert all(b[c] == empty_text("0") for c, _ in HOURLY_SUMS) and b.HEART_RATE_ARR == empty_text("")
    steps = empty_text("0").replace("12:00:00=0", "12:00:00=124").replace("13:00:00=0", "13:00:00=200")
    assert a.STEPS_ARR == steps and a.FLIGHTS_ARR == empty_text("0") and a.SLEEP_ARR is None
    at = F.lit(f"{DAY} 03:04:05").cast("timestamp_ntz")
    odd = lambda *v: F.array(*[F.struct(t.alias("DATE"), x.alias("val")) for t, x in v])
    null = F.lit(None).cast("double")
    table = table.withColumns({
        "STEPS_ARR": odd((at, F.lit(-0.004)), (F.lit(None).cast("timestamp_ntz"), F.lit(3.0)), (at, null)),
        "FLIGHTS_ARR": F.filter("FLIGHTS_ARR", lambda x, i: i < 2), "BASAL_ARR": F.lit(None).cast(
            table.schema["BASAL_ARR"].dataType)})
    row = registered._pop_agg_text(table).filter("ID = 'B'").first()
    assert row.STEPS_ARR == f"{DAY} 03:04:05=0;300;{DAY} 03:04:05" and row.BASAL_ARR is None
    assert row.FLIGHTS_ARR == f"{DAY} 00:00:00=0;{DAY} 01:00:00=0"


def test_methods_that_are_never_compiled_are_left_out_unless_the_session_says(spark):
    session = spark.newSession()
    sizing.compiled_methods(session)
    assert session.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    session.conf.set("spark.sql.codegen.hugeMethodLimit", "60000")
    sizing.compiled_methods(session)
    assert session.conf.get("spark.sql.codegen.hugeMethodLimit") == "60000"


def test_reasons_parse_each_document_once(spark):
    found = documents.rejected(documents.judged(records(spark, document("A"), " ", document("A")[:-1])))
    assert plan_of(found).count("from_json") == 1
    assert sorted(r.REASON for r in found.collect()) == ["empty", "malformed"]


def test_envelopes_are_looked_for_where_they_may_be(spark):
    cases = {
        '{"body":{"a":"1"}}': '{"a":"1"}', "{'body':{'a':'1'}}": '{"a":"1"}', '{"\\u0062ody":{"a":"1"}}': '{"a":"1"}',
        '{"a":"1"}': '{"a":"1"}', '{"a":"body"}': '{"a":"body"}', '{"a":"\\u0062ody"}': '{"a":"\\u0062ody"}', "no": "no",
    }
    rows = spark.createDataFrame([(c, n) for n, c in enumerate(cases)], "C string, N int")
    got = rows.select("N", documents.unwrap(F.col("C")).alias("D")).orderBy("N").collect()
    assert [r.D for r in got] == list(cases.values())


def test_pieces_get_back_their_braces(spark):
    text = '{"body":{"a":"1"}}{"a":"2"} \n {"body": {"a":"3"} } \n{"a":"4"}\t'
    pieces = [(p,) for p in text.split('}{"')]  # as a file is cut
    got = documents.frame(spark.createDataFrame(pieces, "value string")).collect()
    assert sorted(r[RECORD].replace(" ", "").strip() for r in got) == [f'{{"a":"{n}"}}' for n in (1, 2, 3, 4)]


def test_uploads_are_cut_into_documents_once(spark, tmp_path, monkeypatch):
    """A batch is stored before it is looked at: neither its content nor its tables go back to the upload files."""
    seen, count = [], refresh.content_of
    monkeypatch.setattr(refresh, "content_of", lambda df, *columns: seen.append(plan_of(df)) or count(df, *columns))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("".join(document(u, StepCount=[quantity(1, f"{DAY} 12:00:00")]) for u in "AB"))
    batch, root = documents.read_documents(spark, str(tmp_path / "in")), str(tmp_path / "store")
    assert refresh.refresh_batch(batch, None, root) == refresh.refresh_batch(batch, None, root) == 0
    assert len(seen) == 2 and not any("split(" in x or " text" in x for x in seen)
    assert not list((tmp_path / "store" / "arriving").iterdir())
    assert refresh.stored_days(spark, root).count() == 2


def test_days_behind_days_are_put_together_before_they_are_multiplied(spark):
    dates = [dt.date(2024, 1, 1) + dt.timedelta(days=n) for n in (0, 1, 2, 9, 10, 40)]
    keys = spark.createDataFrame([(u, d) for u in ("A", "B", None) for d in dates], "ID string, DATE date").repartition(3)
    needed = refresh._needed(keys)
    got = [tuple(r) for r in needed.collect()]
    want = {(u, d - dt.timedelta(days=n)) for u in ("A", "B", None) for d in dates for n in range(10)}
    assert set(got) == want and len(got) == len(want)
    plan = plan_of(needed)
    assert plan.index("Generate") < plan.index("Aggregate")  # above it


def test_rows_of_one_folder_are_not_settled_again(spark, tmp_path):
    root, calendar = str(tmp_path / "s"), Calendar(dt.date(2024, 1, 5), 3)
    steps = lambda n, u: document("A", StepCount=[quantity(n, f"{DAY} 12:00:00", uuid=u)])
    values = lambda: [r.STEPS for r in refresh.stored_days(spark, root).collect()]
    refresh.refresh_batch(records(spark, steps(1, "x")), None, root, calendar)
    for merged in (False, True):
        assert not merged or refresh.compact(spark, root)
        for rows in (refresh.stored_days, refresh.stored_samples, refresh.stored_population):
            assert not any(x in plan_of(rows(spark, root)) for x in ("Aggregate", "Join"))
        assert values() == [1]
    refresh.refresh_batch(records(spark, steps(1, "x"), steps(2, "y")), None, root, calendar)
    assert values() == [3] and refresh.stored_samples(spark, root).count() == 2
    assert refresh.compact(spark, root) and values() == [3] and refresh.stored_population(spark, root).count() == 1
    refresh.refresh_batch(records(spark, steps(4, "z")), None, root, calendar)
    assert refresh.compact(spark, root) and values() == [7]
    table = refresh._tables(spark)["days"]
    assert levels.read(spark, root, table).count() == len(levels.manifest(spark, root).runs["days"])
    assert tables.exists(spark, f"{root}/arriving")
