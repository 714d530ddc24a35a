"""A training-corpus pipeline: quality, near duplicates, benchmark leaks, secrets, tokens.

Each stage works on all that the one before kept, written as Parquet and read again. The first four return the
columns of `documents`; the last returns the token ids of each document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import bpe, decontaminate, jaccard, quality, secrets
from pulsegrid.llm.queries import OWNER, REPOSITORY, _tokenizer, on_workers
from pulsegrid.llm.storage import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    on_workers(spark)
    scorer, model = quality.train(docs, "text", "doc_id")
    return quality.classify(docs, scorer, model, "text", COLUMNS).where("kept").select(COLUMNS)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group; a document without an id comes last. A record is a doc_id with its
    text: rows that repeat both are copies, whatever the id, and texts that share an id stand for themselves. Rows
    without words are no copies, and all stay."""
    on_workers(spark)
    words = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")) > 0
    records = docs.select(*COLUMNS, F.when(words, F.xxhash64("doc_id", "text")).alias("record"))
    worded = records.where("record IS NOT NULL")
    kept = jaccard.jaccard_first(worded, "record", "text", "doc_id").withColumnRenamed("key", "record")
    chosen = worded.join(kept, "record", "left_semi").dropDuplicates(["record"])
    return chosen.select(COLUMNS).unionByName(records.where("record IS NULL").select(COLUMNS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    on_workers(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.matched(docs, items, "text", COLUMNS).where(F.size("matches") == 0).select(COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    found = secrets.scan(docs, "text", OWNER, REPOSITORY, {c: c for c in COLUMNS})
    masked = secrets.redacted(F.col("text"), F.concat("base", "owned"))
    return found.withColumn("text", masked).withColumn(
        "n_chars", F.length("text").cast("long")).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding."""
    on_workers(spark)
    return bpe.encode(docs, *_tokenizer(), "text", ["doc_id", "lang", "source"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("near_copies", one_of_near_copies),
    ("benchmark", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", tokens),
]
#: Most stages are not expressible in SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
