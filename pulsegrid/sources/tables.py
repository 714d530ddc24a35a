"""Tables on shared storage: clustered writes, versioned publication, bounded reads."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.schema import GRADED_DIET

SAMPLE_ORDER = ("DAY", "METRIC", "ID", "STARTTIME", "VALUE", "UUID")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("no shared folder: set spark.checkpoint.dir")
    return named.rstrip("/")


def local_folder(spark: SparkSession) -> None:
    """Name a folder of this machine as the shared one, where the master is local and none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pulsegrid-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/pulsegrid-{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, path: str, *partitions: str) -> DataFrame:
    """Create or replace a whole Parquet table and read it back."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clustered(rows: DataFrame, *columns: str, parts: int | None = None) -> DataFrame:
    """Range-partition and sort, so files cover narrow key ranges and readers can skip them.

    All the columns take part in the ranges: a busy user is cut by time, a busy second by sample.
    """
    ranges = columns if parts is None else (parts, *columns)
    return rows.repartitionByRange(*ranges).sortWithinPartitions(*columns)


def gathered(rows: DataFrame, partition: str, *columns: str) -> DataFrame:
    """Rows of one partition value together, in order of the columns, in files of about the advised size.

    Unlike ``clustered`` this reads its input once: the exchange decides by the sizes it finds where to cut a large
    value and which small ones to put together.
    """
    return rows.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *columns)


def store_samples(samples_df: DataFrame, path: str) -> DataFrame:
    return store(clustered(samples_df, *SAMPLE_ORDER), path, "DAY")


# Row groups small enough for one user's rows to be found, and a Bloom filter of users in each.
LOOKUP = {
    "parquet.block.size": str(16 << 20), "parquet.bloom.filter.enabled#ID": "true",
    "parquet.bloom.filter.expected.ndv#ID": "20000",
}


def store_fact(fact_df: DataFrame, path: str) -> DataFrame:
    """A fact table clustered by user and time: a user's rows lie in few files, a busy user's are cut by time, and a
    question about one user or range opens the files and row groups that have it."""
    rows = clustered(fact_df, "ID", "STARTTIME", "VALUE", "UUID")
    rows.write.mode("overwrite").options(**LOOKUP).parquet(path)
    return fact_df.sparkSession.read.schema(fact_df.schema).parquet(path)


def store_bucketed(rows: DataFrame, path: str, buckets: int, *keys: str) -> DataFrame:
    """A table dealt into buckets by keys and sorted in each, so that joins and groupings by these keys need no exchange.

    For tables of one row a key, such as user-days: all rows of a key are in one bucket. The bucket layout is known to
    the session's catalogue, under a name made from the path.
    """
    spark = rows.sparkSession
    name = "pulsegrid_" + re.sub(r"\W", "_", path)[-100:].lower()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(
        *keys).option("path", path).saveAsTable(name)
    return spark.table(name)


def append_row(spark: SparkSession, path: str, **values: Column) -> None:
    spark.range(1).select(*[v.alias(k) for k, v in values.items()]).write.mode("append").parquet(path)


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = file_system(spark, path)
    return fs.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    fs, found = file_system(spark, path)
    fs.delete(found, True)


def _complete_versions(spark: SparkSession, root: str) -> list[str]:
    """Folder names of finished versions, oldest first."""
    fs, pattern = file_system(spark, f"{root}/version=*/_SUCCESS")
    names = [x.getPath().getParent().getName() for x in fs.globStatus(pattern) or []]
    return sorted(names, key=lambda n: (int(re.match(r"version=(\d+)", n)[1]), n))


def new_version(spark: SparkSession, root: str) -> str:
    """A folder of its own for the next version, whoever else writes one at the same time."""
    versions = _complete_versions(spark, root)
    number = int(re.match(r"version=(\d+)", versions[-1])[1]) + 1 if versions else 1
    return f"{root}/version={number}-{uuid.uuid4().hex[:8]}"


def complete(spark: SparkSession, version: str) -> None:
    """Readers move over to the version from here on."""
    fs, marker = file_system(spark, f"{version}/_SUCCESS")
    fs.create(marker).close()


def publish(df: DataFrame, root: str, view: str | None = None) -> str:
    """Write a new version beside the older ones; readers move over once it is complete.

    The commit marker Spark writes last is the switch, so a lost driver or a failed write leaves
    readers on the version before. Older versions stay, since views and running queries may read
    them; ``expire`` drops them.
    """
    version = new_version(df.sparkSession, root)
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(version)
    if view:
        current(df.sparkSession, root).createOrReplaceTempView(view)
    return version


def expire(spark: SparkSession, root: str, keep: int) -> None:
    """Drop all versions but the last ``keep``. Views on dropped versions can't be read any more."""
    for name in _complete_versions(spark, root)[:-keep]:
        remove(spark, f"{root}/{name}")


def current(spark: SparkSession, root: str, table: str = "") -> DataFrame:
    """The newest version, or one table of it."""
    versions = _complete_versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"no published version under {root}")
    return spark.read.parquet(f"{root}/{versions[-1]}/{table}".rstrip("/"))


def share(tables: dict[str, DataFrame]) -> None:
    """Pass-through views by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str, **bound) -> DataFrame:
    """SQL text with named parameters (``:name``), never formatted into the text."""
    return spark.sql(sql, args=bound)


def column_names(spark: SparkSession, table: str) -> list[str]:
    return spark.table(table).columns


def fetch(df: DataFrame, rows: int):
    """At most ``rows`` rows as pandas, for display."""
    return df.limit(rows).toPandas()


def top(df: DataFrame, rows: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(rows)


def read_graded_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=GRADED_DIET)
