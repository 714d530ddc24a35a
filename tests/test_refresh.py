from pyspark.sql import functions as F

from pulsegrid.plans import refresh
from pulsegrid.sources import tables
from pulsegrid.streaming import ingest, rollup as stream_rollup
from pulsegrid.operators import rollup
from test_wide import CAL, RUN, build, rows_of, uploads
from uploads import document, quantity, records, samples_of, stage


def stored(spark, root):
    return rows_of(refresh.stored_pop_agg(spark, root, CAL, F.lit(RUN)))


def late_upload():
    t = "2024-01-03 15:00:00"
    return [
        document("A", age=35, loaddate="2024-01-20 04:00:00 +0000",
                 ActiveEnergyBurned=[quantity(1000, t, unit="Cal", uuid="late")],
                 SleepAnalysis=[stage(4, "2024-01-04 23:30:00", "2024-01-04 23:55:00", "evening")]),
        document("NEW", StepCount=[quantity(3, t)]),
    ]


def test_batches_equal_a_full_rebuild(spark, tmp_path):
    root = str(tmp_path)
    first, second = uploads(), late_upload() + uploads()[1:2]  # one upload comes again
    refresh.refresh_batch(records(spark, *first), 0, root, CAL)
    refresh.refresh_batch(records(spark, *second), 1, root, CAL)
    refresh.refresh_batch(records(spark, *second), 1, root, CAL)  # the same batch again
    assert stored(spark, root) == rows_of(build(spark, first + second)[2])


def test_only_touched_days_are_recomputed(spark, tmp_path):
    root = str(tmp_path)
    refresh.refresh_batch(records(spark, *uploads()), 0, root, CAL)
    refresh.refresh_batch(records(spark, *late_upload()), 1, root, CAL)
    days = spark.read.parquet(f"{root}/days").filter("BATCH = 1")
    got = sorted({(r.ID, r.DATE.day) for r in days.collect()})
    # energy: its day and the nine after; sleep: its day and its night's; steps: their day
    assert got == [("A", d) for d in range(3, 13)] + [("NEW", 3)]


def test_batch_without_samples_or_users(spark, tmp_path):
    root = str(tmp_path)
    refresh.refresh_batch(records(spark, document("A")), 0, root, CAL)
    assert len(stored(spark, root)) == CAL.days
    refresh.refresh_batch(records(spark, *late_upload()), 1, root, CAL)
    assert len(stored(spark, root)) == 2 * CAL.days


def test_full_refresh_publishes_versions(spark, tmp_path):
    root = str(tmp_path)
    recs = records(spark, *uploads())
    first = refresh.full_refresh(recs, root, CAL, F.lit(RUN), view="POP_AGG")
    assert "/version=1-" in first
    assert rows_of(spark.table("POP_AGG").drop("MONTH")) == rows_of(build(spark, uploads())[2])
    both = records(spark, *uploads(), *late_upload())
    assert "/version=2-" in refresh.full_refresh(both, root, CAL, F.lit(RUN))
    assert rows_of(tables.current(spark, root, "pop_agg").drop("MONTH")) == rows_of(
        build(spark, uploads() + late_upload())[2])
    (tmp_path / "version=3-unfinished").mkdir()  # a write that never finished
    # four users; one day has two units of active energy
    assert tables.current(spark, root, "pop_agg").count() == 4 * CAL.days + 1
    assert rows_of(spark.table("POP_AGG").drop("MONTH")) == rows_of(
        build(spark, uploads())[2])  # the view's own version
    assert spark.read.parquet(f"{root}/updates").count() == 2


def test_batches_that_count_from_zero_again_overwrite_nothing(spark, tmp_path):
    root = str(tmp_path)
    first, second = uploads(), late_upload()
    assert refresh.refresh_batch(records(spark, *first), 0, root, CAL) == 0
    assert refresh.refresh_batch(records(spark, *second), 0, root, CAL) == 1
    assert refresh.refresh_batch(records(spark, *first), 0, root, CAL) == 0
    assert stored(spark, root) == rows_of(build(spark, first + second)[2])
    assert not list((tmp_path / "slice").glob("BATCH=*"))


def test_no_end_date_unless_asked_for(spark, tmp_path):
    root = str(tmp_path)
    refresh.refresh_batch(records(spark, document("A", StepCount=[quantity(3, "2025-06-05 15:00:00")])), 0, root)
    rows = refresh.stored_pop_agg(spark, root).filter("STEPS is not null").collect()
    assert [(r.ID, r.DATE.isoformat(), r.STEPS) for r in rows] == [("A", "2025-06-05", 3.0)]
    refresh.full_refresh(records(spark, document("A", StepCount=[quantity(3, "2025-06-05 15:00:00")])), root + "/f")
    assert tables.current(spark, root + "/f", "pop_agg").filter("STEPS = 3").count() == 1


def test_compaction_changes_no_result(spark, tmp_path):
    root = str(tmp_path)
    third = [document("A", StepCount=[quantity(9, "2024-01-04 15:00:00", uuid="third")])]
    for docs in (uploads(), late_upload()):
        refresh.refresh_batch(records(spark, *docs), 0, root, CAL)
    refresh.compact(spark, root)
    assert stored(spark, root) == rows_of(build(spark, uploads() + late_upload())[2])
    refresh.refresh_batch(records(spark, *third), 0, root, CAL)
    want = rows_of(build(spark, uploads() + late_upload() + third)[2])
    assert stored(spark, root) == want
    refresh.compact(spark, root)
    assert stored(spark, root) == want
    assert sorted(p.name for p in (tmp_path / "days").glob("BATCH=*")) == ["BATCH=2"]


def test_samples_without_identifier_touch_nothing(spark, tmp_path):
    root = str(tmp_path)
    nobody = document("A", StepCount=[quantity(3, "2024-01-03 15:00:00")]).replace('"identifier"', '"unknown"')
    refresh.refresh_batch(records(spark, nobody, *uploads()), 0, root, CAL)
    assert stored(spark, root) == rows_of(build(spark, uploads())[2])


def test_upload_stream_keeps_the_wide_table(spark, tmp_path):
    inbox, root, progress = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "progress")
    inbox.mkdir()
    run = lambda: ingest.start_refresh(
        spark, str(inbox), root, progress, CAL, once=True).awaitTermination()
    (inbox / "a.json").write_text("".join(uploads()))
    run()
    assert stored(spark, root) == rows_of(build(spark, uploads())[2])
    (inbox / "b.json").write_text("".join(f'{{"body":{d}}}' for d in late_upload()))
    run()
    run()  # nothing new
    assert stored(spark, root) == rows_of(build(spark, uploads() + late_upload())[2])
    assert spark.read.parquet(f"{root}/days").agg(F.max("BATCH")).first()[0] == 1


def test_exact_totals_at_any_lateness(spark, tmp_path):
    samples = samples_of(spark, *uploads())
    root = str(tmp_path / "out")
    for i, days in enumerate((F.col("DAY") > "2024-01-03", F.col("DAY") <= "2024-01-03", F.lit(True))):
        samples.filter(days).write.parquet(str(tmp_path / f"s{i}"))
        stream = spark.readStream.schema(samples.schema).parquet(str(tmp_path / f"s{i}"))
        stream_rollup.start_totals(stream, root, str(tmp_path / f"p{i}")).awaitTermination()
    got = {(r.ID, r.METRIC, r.UNIT, r.START.date()): r.VALUE
           for r in stream_rollup.totals(spark, root).collect()}
    want = {}
    for m in {r.METRIC for r in samples.select("METRIC").distinct().collect()}:
        for r in rollup.daily_sum(samples.filter(F.col("METRIC") == m)).collect():
            want[r.ID, m, r.UNIT, r.DATE] = r.VALUE
    assert got == want


def test_landing_stream(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.json").write_text("".join(uploads()))
    q = ingest.start_landing(spark, str(inbox), str(tmp_path / "land"), str(tmp_path / "p"), True)
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "land")).count() == len(uploads())


def test_windowed_stream_equals_daily_sum(spark, tmp_path):
    samples = samples_of(spark, *uploads()).drop("DAY")
    for i in range(2):  # the second file repeats the first
        samples.coalesce(1).write.mode("append").parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "s"))
    root = str(tmp_path / "out")
    windows = stream_rollup.windowed_totals(stream, "1 day", "30 days")
    stream_rollup.start(windows, root, str(tmp_path / "p")).awaitTermination()
    got = {
        (r.ID, r.METRIC, r.UNIT, r.START.date()): r.VALUE
        for r in stream_rollup.windows(spark, root).collect()
    }
    want = {}
    for m in ("STEPCOUNT", "SLEEP", "CARBS"):
        for r in rollup.daily_sum(samples.filter(F.col("METRIC") == m)).collect():
            want[r.ID, m, r.UNIT, r.DATE] = r.VALUE
    assert {k: v for k, v in got.items() if k[1] in ("STEPCOUNT", "SLEEP", "CARBS")} == want
