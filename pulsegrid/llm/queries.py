"""Registered queries of this subpackage, and the SQL that some of them are compared with."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import (
    bpe, chat, decontaminate, hard_negatives, jaccard, langid, neighbours, phrases, prefix_trie, quality, secrets,
    sharding, toxicity,
)
from pulsegrid.llm.sample import drawn

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
OWNER, REPOSITORY = "source", "doc_id"
SHARDS = 16
TOXIC_AT = 0.3
#: Bytes of rows that are sent to a Python worker at a time, unless the session has a limit of its own. Without one, up to
#: 10,000 rows are sent, whatever they hold, and both processes keep several copies of them.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
_ROOT = Path(__file__).resolve().parents[2]


def on_workers(spark: SparkSession) -> None:
    """Python workers import this package. Where the session's PYTHONPATH doesn't name it, it is sent to them. Rows go
    to them in batches of bounded size."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT in paths or getattr(context, "_pulsegrid_sent", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="pulsegrid-")) / "pulsegrid_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((_ROOT / "pulsegrid").rglob("*.py")):
            out.write(file, file.relative_to(_ROOT))
    context.addPyFile(str(archive))
    context._pulsegrid_sent = True


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(key: str, divisor: int):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % divisor


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").where(F.col("toxic").isNotNull())
    held_out = _remainder("doc_id", 4) == 2
    limit = toxicity.SAMPLE_ROWS
    # Labelled ids are drawn before their texts are looked up, so that only the sample's texts are joined.
    known = drawn(labels.where(~held_out), limit, "doc_id", "toxic")
    machine = toxicity.train(documents.join(F.broadcast(known), "doc_id"), "text", "toxic", "doc_id", limit)
    scored = toxicity.score(documents.select("doc_id", held_out.alias("held_out"), "text"), machine, "text",
                            ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_AT).cast("int"))


def _tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return bpe.encode(documents, *_tokenizer(), "text", ["doc_id"], with_ids=False)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    found = secrets.scan(documents, "text", OWNER, REPOSITORY, {"doc_id": "doc_id"})
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.array_sort(F.concat("base", "owned"))).alias("spans"),
        F.size("owned").cast("long").alias("n_owned"), "n_live", "n_example",
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    dealt = sharding.shard_records(documents, "doc_id", "text", [1.0] * SHARDS)
    return dealt.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                        "grown_shard")


def op5_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return phrases.dedup_phrases(documents, "doc_id", "text", with_text=False).withColumnRenamed("key", "doc_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer, model = quality.train(documents, "text", "doc_id")
    return quality.classify(documents, scorer, model, "text", ["doc_id"])


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return jaccard.jaccard_components(documents, "doc_id", "text").withColumnRenamed("key", "doc_id")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "id % 20 = 0")


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = _remainder("doc_id", 5) == 0
    model = langid.train(documents.where(~held_out), "text", "lang", "doc_id")
    return langid.identify(documents.select("doc_id", held_out.alias("held_out"), "text"), model, "text",
                           ["doc_id", "held_out"])


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontaminate.matched(documents, items, "text", ["doc_id"])
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.items(_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    conv = F.col("conv")
    taken = F.crc32(conv.cast("string").cast("binary")) % 9
    return prefix_trie.nodes(prefix_trie.rebuilt(turns, conv - conv % 5, taken, 8))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), "vec_id", label, "embedding", "id % 100 = 0")


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    said = said.unionByName(spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], said.schema))
    turns = said.withColumn("parts", chat.text_part(F.coalesce("text", F.lit(""))))
    return chat.digests(chat.read_back(chat.formatted(turns, "conv_id", "turn", "role", "parts")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_toxicity, op2_bpe, op3_secrets, op4_sharding, op5_phrases, op6_quality, op7_jaccard, op8_neighbours,
        op9_langid, op10_decontaminate, op11_prefix_trie, op12_hard_negatives, op13_chat_format,
    )}


def oracle_sql() -> dict[str, str]:
    from pulsegrid.llm import conversation_sql, sql

    return {
        "op3_secrets": sql.SECRETS, "op5_phrases": sql.PHRASES, "op7_jaccard": sql.JACCARD,
        "op11_prefix_trie": conversation_sql.TRIE, "op12_hard_negatives": conversation_sql.HARD_NEGATIVES,
        "op13_chat_format": conversation_sql.CHATS,
    }
