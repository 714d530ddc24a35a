import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import sizing
from pulsegrid.sources import tables
from uploads import document, quantity, samples_of


def test_shared_folder_is_the_one_the_cluster_names(spark):
    assert tables.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_samples_are_stored_by_day_in_order(spark, tmp_path):
    s = samples_of(spark, *[
        document(f"U{u}", StepCount=[quantity(i, f"2024-01-0{d} 12:00:0{i}", uuid=f"{d}{i}")
                                     for d in (1, 2) for i in range(3)]) for u in range(4)])
    stored = tables.store_samples(s, str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").glob("DAY=*")) == [
        "DAY=2024-01-01", "DAY=2024-01-02"]
    assert stored.exceptAll(s).count() == 0 and s.exceptAll(stored).count() == 0
    plan = stored.filter(F.col("DAY") == dt.date(2024, 1, 1))._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(DAY" in plan.toString()


def test_query_binds_values(spark):
    spark.createDataFrame([("PIN1' OR '1'='1", 1), ("PIN1", 2)], "ID string, N int"
                          ).createOrReplaceTempView("PINS")
    got = tables.query(spark, "SELECT N FROM PINS WHERE ID = :pin", pin="PIN1' OR '1'='1")
    assert [r.N for r in got.collect()] == [1]
    assert tables.column_names(spark, "PINS") == ["ID", "N"]
    assert len(tables.fetch(spark.table("PINS"), 1)) == 1


class Unnamed:
    """A session in which no shared folder is named."""

    def __init__(self, master):
        self.master, self.folder = master, None
        self.conf = self.sparkContext = self

    def get(self, key, default=None):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_shared_folder_must_be_named():
    for master in ("spark://host:7077", "local[2]"):
        with pytest.raises(ValueError):
            tables.shared_folder(Unnamed(master))
    cluster, local = Unnamed("spark://host:7077"), Unnamed("local[2]")
    tables.local_folder(cluster)
    tables.local_folder(local)
    assert cluster.folder is None and tables.shared_folder(local) == local.folder


def test_views_survive_publishes_until_versions_expire(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.publish(spark.range(1), root, view="FIRST")
    names = [tables.publish(spark.range(n), root).split("/")[-1] for n in (2, 3, 4)]
    assert spark.table("FIRST").count() == 1
    assert tables.current(spark, root).count() == 4
    # two writers that start together take the same number and different folders
    a, b = tables.new_version(spark, root), tables.new_version(spark, root)
    assert a != b and "/version=5-" in a and "/version=5-" in b
    tables.expire(spark, root, keep=2)
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == sorted(names[1:])


def test_current_needs_a_published_version(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.current(spark, str(tmp_path / "none"))


def test_broadcast_only_when_counted_small(spark):
    df = spark.range(11)
    assert sizing.is_small(df, 11) and not sizing.is_small(df, 10)
    hinted = lambda n: "broadcast" in sizing.broadcast_if_small(df, n)._jdf.queryExecution(
        ).analyzed().toString().lower()
    assert hinted(11) and not hinted(10)
