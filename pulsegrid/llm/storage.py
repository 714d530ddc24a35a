"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. A local master without one (tests) gets a folder of its own;
    a cluster without one is an error, as executors would write to their own disks."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"{SETTING} names no shared folder")
        folder = tempfile.mkdtemp(prefix="pulsegrid-llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step's rows as Parquet and read them back: later steps start from the files, whatever is lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
