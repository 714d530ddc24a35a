"""Tables that grow by batches: claims, levels, writers at the same time."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.plans import refresh, wide
from pulsegrid.operators import insights, population, rollup
from pulsegrid.sources import claims, documents, levels, tables
from pulsegrid.sources.dimensions import Calendar
from pulsegrid.streaming import ingest
from pulsegrid.streaming import rollup as stream_rollup
from test_refresh import late_upload, stored
from test_wide import CAL, RUN, build, rows_of, uploads
from uploads import document, quantity, records, samples_of

ROWS = levels.Table("rows", T.StructType([T.StructField("K", T.LongType()), T.StructField("V", T.LongType())]),
                    lambda rows: refresh.newest(rows, "K").coalesce(1), numbered=True)


def add(spark, root, number, rows):
    df = spark.createDataFrame(rows, ROWS.schema).coalesce(1)
    return tables.store(df, f"{root}/rows/BATCH={number}")


def newest_rows(spark, root):
    return sorted((r.K, r.V) for r in refresh.newest(levels.read(spark, root, ROWS), "K").collect())


def test_claims_go_to_one_writer(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: claims.next_number(spark, folder, 4, f"w{i}"), range(24)))
    assert sorted(got) == list(range(5, 29)) == claims.numbers(spark, folder)
    assert claims.text_of(spark, f"{folder}/{got[3]}") == "w3"
    assert not claims.claim(spark, f"{folder}/5", "late") and claims.text_of(spark, f"{folder}/none") is None


def test_folders_do_not_grow_with_batches(spark, tmp_path):
    """200 batches of one row, merged after every tenth: few folders, and every row in its newest form."""
    root, want, most = str(tmp_path), {}, 0
    for n in range(200):
        row = (n % 37, n)
        want[row[0]] = row[1]
        add(spark, root, n, [row])
        if n % 10 == 9:
            assert levels.merge(spark, root, [ROWS], fanout=3)
            most = max(most, levels.folders(spark, root, "rows"))
    assert most <= 2 * 5 and levels.folders(spark, root, "rows") <= 2 * 5  # two runs a level, log3 of 20 merges
    assert newest_rows(spark, root) == sorted(want.items())
    assert len(list((tmp_path / "rows").glob("BATCH=*"))) == 10  # those of the last merge, until the next
    assert len(list((tmp_path / "manifest").iterdir())) <= 3
    kept = {r["path"] for r in levels.manifest(spark, root).runs["rows"]}
    assert len(list((tmp_path / "base/rows").iterdir())) <= len(kept) + 3
    assert not levels.merge(spark, root, [ROWS])  # nothing new


def test_only_finished_folders_are_read_and_late_ones_are_not_lost(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, 3, [(1, 30)])
    torn = tmp_path / "rows/BATCH=4"
    add(spark, root, 4, [(1, 40)])
    (torn / "_SUCCESS").unlink()
    assert newest_rows(spark, root) == [(1, 30)]
    assert levels.merge(spark, root, [ROWS])
    add(spark, root, 2, [(2, 20)])  # a slow writer, behind the merge
    assert newest_rows(spark, root) == [(1, 30), (2, 20)]
    (torn / "_SUCCESS").touch()
    assert levels.merge(spark, root, [ROWS])
    assert newest_rows(spark, root) == [(1, 40), (2, 20)]


def test_one_of_two_merges_counts(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    add(spark, root, 0, [(1, 1)])
    inner, first = claims.claim, []

    def beaten(spark, path, text=""):
        if "/manifest/" in path and not first:
            first.append(True)
            assert levels.merge(spark, root, [ROWS])  # another writer comes first
        return inner(spark, path, text)

    monkeypatch.setattr(claims, "claim", beaten)
    assert not levels.merge(spark, root, [ROWS])
    assert newest_rows(spark, root) == [(1, 1)] and levels.folders(spark, root, "rows") == 1
    claims.claim(spark, f"{root}/manifest/7", "")  # its writer was lost
    monkeypatch.setattr(claims, "_PATIENCE_S", 0.0)
    add(spark, root, 1, [(2, 2)])
    assert levels.merge(spark, root, [ROWS]) and newest_rows(spark, root) == [(1, 1), (2, 2)]


def test_two_interleaved_writers_lose_nothing(spark, tmp_path, monkeypatch):
    """The second writer does its whole batch between the first one's samples and its look at the samples."""
    root, other = str(tmp_path), [document("A", StepCount=[quantity(9, "2024-01-04 15:00:00", uuid="other")])]
    inner, done = refresh.next_order, []

    def interrupted(spark, where):
        order = inner(spark, where)
        if not done:
            done.append(True)
            assert refresh.refresh_batch(records(spark, *other), None, root, CAL) == 1
        return order

    monkeypatch.setattr(refresh, "next_order", interrupted)
    assert refresh.refresh_batch(records(spark, *uploads()), None, root, CAL) == 0
    assert stored(spark, root) == rows_of(build(spark, uploads() + other)[2])


def test_a_broken_batch_is_done_anew_behind_later_ones(spark, tmp_path, monkeypatch):
    root, other = str(tmp_path), late_upload()
    with monkeypatch.context() as m:
        m.setattr(refresh, "next_order", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            refresh.refresh_batch(records(spark, *uploads()), None, root, CAL)
    assert refresh.refresh_batch(records(spark, *other), None, root, CAL) == 1
    assert refresh.refresh_batch(records(spark, *uploads()), None, root, CAL) == 0
    want = rows_of(build(spark, uploads() + other)[2])
    assert stored(spark, root) == want
    assert refresh.compact(spark, root) and refresh.refresh_batch(records(spark, *other), None, root, CAL) == 1
    third = [document("A", StepCount=[quantity(2, "2024-01-04 15:00:00", uuid="third")])]
    assert refresh.refresh_batch(records(spark, *third), None, root, CAL) == 2
    assert refresh.compact(spark, root)
    assert refresh.refresh_batch(records(spark, *uploads()), None, root, CAL) == 0  # known from the merged ledger
    assert not list((tmp_path / "ledger/content").glob("*")) or len(list((tmp_path / "ledger/content").glob("*"))) == 1
    assert stored(spark, root) == rows_of(build(spark, uploads() + other + third)[2])


def jobs_of(spark, run):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    try:
        out = run()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return out, len(tracker.getJobIdsForGroup("counted"))


def test_planning_wide_days_starts_no_job(spark):
    samples, pop, _ = build(spark, uploads())
    keys = population.day_spine(pop, CAL).persist()
    keys.count()
    made, jobs = jobs_of(spark, lambda: wide.wide_days(samples, keys, CAL))
    assert jobs == 0 and "VARIANT" not in made.columns
    assert jobs_of(spark, made.count)[1] > 0


def test_a_range_of_one_user_opens_few_files(spark, tmp_path):
    cal = Calendar(dt.date(2024, 1, 1), 120)
    samples, pop, _ = build(spark, uploads())
    agg = wide.pop_agg(samples, pop, cal, F.lit(RUN), by_month=True)
    table = wide.store_pop_agg(agg, str(tmp_path / "agg"))
    assert len(list((tmp_path / "agg").glob("MONTH=*"))) == 4
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    trend = insights.trend(table, dt.date(2024, 2, 10), dt.date(2024, 3, 5), id="A")
    assert "MONTH" not in trend.columns
    plan = trend._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "MONTH" in filters and "2024-02-01" in filters and "2024-03-01" in filters
    assert "EqualTo(ID,A)" in plan.split("PushedFilters: ")[1]
    rows = trend.collect()
    assert [r.DATE for r in rows] == [dt.date(2024, 2, 10) + dt.timedelta(days=i) for i in range(25)]
    files = table.filter("ID = 'A'").select(F.input_file_name().alias("F"), "MONTH").distinct().groupBy("MONTH").count()
    assert {r["count"] for r in files.collect()} == {1}
    import pyarrow.parquet as pq

    file = next((tmp_path / "agg/MONTH=2024-02-01").glob("*.parquet"))
    row_group = pq.ParquetFile(file).metadata.row_group(0)
    assert row_group.column(0).path_in_schema == "ID" and row_group.column(0).statistics.min <= "A"


def test_rejected_documents_are_kept_with_their_reason(spark, tmp_path):
    good = uploads()
    bad = ['{"identifier": "A", "StepCount": [', "not json", "", "  ", None, '{"age": "3"}',
           '{"identifier": "A", "StepCount": {"x": 1}}', '{"identifier": " "}']
    known = documents.judged(records(spark, *good, *bad))
    reasons = sorted(r.REASON for r in documents.rejected(known).collect())
    assert reasons == ["empty"] * 3 + ["malformed"] * 3 + ["no identifier"] * 2
    assert documents.accepted(known).count() == len(good)
    taken = documents.parse_documents(records(spark, *good, *bad), strict=True)
    assert sorted(r.ID for r in taken.collect()) == sorted(
        r.ID for r in documents.parse_documents(records(spark, *good)).collect())
    assert taken._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
    root = str(tmp_path / "s")
    refresh.refresh_batch(records(spark, *good, *bad), None, root, CAL)
    assert stored(spark, root) == rows_of(build(spark, good)[2])
    refresh.compact(spark, root)
    kept = refresh.stored_rejected(spark, root)
    assert kept.count() == len(bad) and kept.filter("REASON = 'malformed'").count() == 3
    assert documents.rejected(documents.judged(records(spark))).count() == 0


def test_a_backlog_is_taken_in_batches_and_archived(spark, tmp_path):
    inbox, landing, old = tmp_path / "in", str(tmp_path / "land"), tmp_path / "old"
    inbox.mkdir()
    for i in range(5):
        (inbox / f"{i}.json").write_text(document(f"U{i}"))
    run = lambda: ingest.start_landing(
        spark, str(inbox), landing, str(tmp_path / "p"), once=True, files_per_batch=2, archive=str(old))
    query = run()
    query.awaitTermination()
    assert [p["numInputRows"] > 0 for p in query.recentProgress].count(True) == 3
    (inbox / "9.json").write_text(document("U9"))
    run().awaitTermination()
    assert spark.read.parquet(landing).count() == 6
    assert list(old.rglob("*.json"))  # taken files have left the inbox
    follow = []
    changes = ingest.landing_changes(spark, landing, 1)
    for name in ("a", "b"):
        place = str(tmp_path / name)
        changes.writeStream.foreachBatch(lambda df, _: follow.append(df.count())).option(
            "checkpointLocation", place).trigger(availableNow=True).start().awaitTermination()
    assert sum(follow) == 12


def totals_of(df):
    return {(r.ID, r.METRIC, r.UNIT, r.START.date()): r.VALUE for r in df.collect()}


def test_exact_totals_keep_late_samples_aside_and_merge_them(spark, tmp_path):
    samples, root = samples_of(spark, *uploads()), str(tmp_path / "out")
    want = {(r.ID, m, r.UNIT, r.DATE): r.VALUE for m in {r.METRIC for r in samples.select("METRIC").distinct().collect()}
            for r in rollup.daily_sum(samples.filter(F.col("METRIC") == m)).collect()}
    for i, part in enumerate((samples.filter("DAY > '2024-01-05'"), samples)):
        part.write.parquet(str(tmp_path / f"s{i}"))
        stream = spark.readStream.schema(samples.schema).parquet(str(tmp_path / f"s{i}"))
        stream_rollup.start_totals(stream, root, str(tmp_path / f"p{i}")).awaitTermination()
    late = stream_rollup.late_windows(spark, root)
    assert late.count() > 0 and late.agg(F.max("DAY")).first()[0] < dt.date(2024, 1, 9)
    assert totals_of(stream_rollup.totals(spark, root)) == want
    assert stream_rollup.merge_late(spark, root) > 0 and stream_rollup.merge_late(spark, root) == 0
    assert late_free(spark, root) and totals_of(stream_rollup.totals(spark, root)) == want
    assert stream_rollup.compact_totals(spark, root)
    assert totals_of(stream_rollup.totals(spark, root)) == want
    again = spark.readStream.schema(samples.schema).parquet(str(tmp_path / "s1"))
    stream_rollup.start_totals(again, root, str(tmp_path / "p9")).awaitTermination()  # all of it once more
    assert totals_of(stream_rollup.totals(spark, root)) == want and levels.folders(spark, root, "samples") == 1


def late_free(spark, root):
    return stream_rollup.late_windows(spark, root).count() == 0


def test_batches_read_the_days_they_touch(spark, tmp_path):
    samples, root = samples_of(spark, *uploads()), str(tmp_path / "out")
    samples.write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(samples.schema).parquet(str(tmp_path / "s"))
    stream_rollup.start_totals(stream, root, str(tmp_path / "p")).awaitTermination()
    touched = samples.filter("DAY = '2024-01-04'").withColumn("START", F.col("DAY").cast("timestamp_ntz"))
    plan = stream_rollup._summed(spark, root, touched)._jdf.queryExecution().executedPlan().toString()
    stored_side = [p for p in plan.split("PartitionFilters: ")[1:] if "DAY" in p.split("]")[0]]
    assert any("2024-01-04" in p.split("PushedFilters")[0] for p in stored_side)


def test_windows_of_another_checkpoint_are_refused(spark, tmp_path):
    samples, root = samples_of(spark, *uploads()).drop("DAY"), str(tmp_path / "out")
    samples.write.parquet(str(tmp_path / "s"))
    run = lambda place: stream_rollup.start(
        stream_rollup.windowed_totals(spark.readStream.schema(samples.schema).parquet(str(tmp_path / "s")), "1 day", "30 days"),
        root, str(tmp_path / place)).awaitTermination()
    run("p0")
    held = totals_of(stream_rollup.windows(spark, root))
    run("p0")  # the same checkpoint goes on
    with pytest.raises(Exception, match="another checkpoint"):
        run("p1")
    assert totals_of(stream_rollup.windows(spark, root)) == held


def test_bucketed_user_days_need_fewer_exchanges(spark, tmp_path):
    samples, pop, _ = build(spark, uploads())
    rows = rollup.user_days(wide.samples_between(samples, CAL))
    plain = tables.store(rows, str(tmp_path / "plain"))
    dealt = tables.store_bucketed(rows, str(tmp_path / "dealt"), 4, "ID", "DATE")
    none = tables.store(wide.exceptional_days(samples), str(tmp_path / "none"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        agg = {k: wide.pop_agg(samples, pop, CAL, F.lit(RUN), days=days, exceptional=none)
               for k, days in (("plain", plain), ("dealt", dealt))}
        exchanges = {k: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
                     for k, df in agg.items()}
        assert exchanges["dealt"] < exchanges["plain"]
        assert rows_of(agg["dealt"]) == rows_of(agg["plain"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_facts_are_clustered_by_user_and_time(spark, tmp_path):
    docs = [document(f"U{u}", HeartRate=[quantity(60 + h, f"2024-01-{d:02d} {h:02d}:00:00", uuid=f"{u}-{d}-{h}")
                                         for d in range(2, 9) for h in range(24)]) for u in range(6)]
    fact = samples_of(spark, *docs)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = tables.store_fact(fact.drop("DAY"), str(tmp_path / "fact"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert table.count() == fact.count() == 6 * 7 * 24
    files = table.groupBy(F.input_file_name().alias("F")).agg(
        F.min(F.struct("ID", "STARTTIME")).alias("A"), F.max(F.struct("ID", "STARTTIME")).alias("Z")).orderBy("A").collect()
    assert len(files) > 1 and all(a.Z <= b.A for a, b in zip(files, files[1:]))
