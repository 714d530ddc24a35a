"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the set of its byte n-grams of two, three and four bytes (with case folded for A-Z), each hashed to a
row of an embedding table. The text's vector is the mean of its rows; a linear layer and softmax give the
languages' chances. Both layers are trained together by stochastic gradient descent in numpy on a bounded sample.
A temperature fitted on rows held back from training calibrates the chances, and the rejection threshold is the
calibrated chance below which the held-back rows are wrong more often than `tolerance` allows.

Because the layers are linear, scoring needs only embedding @ weights: one number per bucket and language, looked
up at every byte of every text, so whole texts are read.

Defined results: null texts and texts without a letter are `und` with score 0; rows without text or language are
not learned from; ties go to the first language in alphabetical order; without any labelled row all is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.arrow import chunks, views
from pulsegrid.llm.sample import drawn

UNDETERMINED = "und"
BUCKETS, DIMENSIONS, EPOCHS, BATCH, RATE = 1 << 15, 16, 4, 64, 0.5
#: Least number of steps: small samples are passed over more often.
LEAST_STEPS = 200
#: Most rows that training reads (those with the smallest hash of their id).
SAMPLE_ROWS = 4000
#: Bytes that are scored at a time.
CHUNK = 1 << 18
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def _fold() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    table[65:91] += 32
    return table


_FOLD = _fold()


def gram_buckets(data: np.ndarray, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """For n = 2, 3, 4 the bucket of the n-gram that starts at each byte (the last n - 1 bytes start none)."""
    folded = _FOLD[data]
    gram = folded.copy()
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    for n, multiplier in zip((2, 3, 4), _MULTIPLIERS, strict=True):
        if len(data) < n:
            yield np.zeros(0, np.uint32)
            continue
        gram = (gram[:-1] << np.uint32(8)) | folded[n - 1 :]
        yield (gram * np.uint32(multiplier) ^ (gram >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> shift


def mean_vector_counts(text: bytes, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one text and the weight of each in the mean."""
    found = np.concatenate(list(gram_buckets(np.frombuffer(text, np.uint8), buckets)))
    rows, counts = np.unique(found, return_counts=True)
    return rows.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # buckets x languages, the embedding table times the linear layer
    bias: np.ndarray
    temperature: float
    threshold: float


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(-1, keepdims=True))
    return z / z.sum(-1, keepdims=True)


def fit(texts: list[str], languages: list[str], seed: int = 7, tolerance: float = 0.05) -> Model:
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    known = {n: i for i, n in enumerate(names)}
    labels = np.array([known[x] for x in languages])
    bags = [mean_vector_counts(t.encode()) for t in texts]
    order = rng.permutation(len(bags))
    held, learned = order[: len(order) // 5], order[len(order) // 5 :]
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.1, (DIMENSIONS, len(names))).astype(np.float32)
    bias = np.zeros(len(names), np.float32)
    batches = max(1, -(-len(learned) // BATCH))
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    steps, step = epochs * batches, 0
    for _ in range(epochs):
        learned = rng.permutation(learned)
        for at in range(0, len(learned), BATCH):
            rows = learned[at : at + BATCH]
            vectors = np.stack([bags[r][1] @ embedding[bags[r][0]] for r in rows])
            error = _softmax(vectors @ weights + bias)
            error[np.arange(len(rows)), labels[rows]] -= 1
            back = error @ weights.T
            rate = RATE * 10 * (1 - step / steps)
            weights -= rate * vectors.T @ error / len(rows)
            bias -= rate * 0.1 * error.mean(0)
            for r, g in zip(rows, back, strict=True):
                embedding[bags[r][0]] -= rate * np.outer(bags[r][1], g)
            step += 1
    table = embedding @ weights
    temperature, threshold = 1.0, 0.0
    if len(held):
        z = np.stack([bags[r][1] @ table[bags[r][0]] for r in held]) + bias
        loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(held)), labels[held]] + 1e-12).mean()
        temperature = float(min(np.geomspace(0.05, 20, 49), key=loss))
        chances = _softmax(z / temperature)
        best = chances.max(1)
        wrong = chances.argmax(1) != labels[held]
        for limit in np.linspace(1 / len(names), 1, 41):
            kept = best >= limit
            if not kept.any() or wrong[kept].mean() <= tolerance:
                threshold = float(limit)
                break
    return Model(names, table.astype(np.float32), bias, temperature, threshold)


def score_batch(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Calibrated chance and number of the likeliest language of each text."""
    if not model.languages:
        return np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    data, offsets = views(texts)
    sums = np.zeros((len(texts), len(model.languages)))
    counts = np.zeros(len(texts))
    nothing = len(model.table)
    table = np.vstack([model.table, np.zeros_like(model.table[:1])])
    for first, last in chunks(offsets, CHUNK):
        part = data[offsets[first] : offsets[last]]
        cuts = offsets[first : last + 1] - offsets[first]
        filled = np.flatnonzero(np.diff(cuts))
        if not len(filled):
            continue
        starts = cuts[:-1][filled]
        for n, found in zip((2, 3, 4), gram_buckets(part, nothing), strict=True):
            counts[first:last] += np.maximum(0, np.diff(cuts) - n + 1)
            rows = np.full(len(part), nothing, np.int64)
            rows[: len(found)] = found
            for back in range(1, n):  # n-grams that run over the end of their text
                rows[np.maximum(cuts[1:][filled] - back, starts)] = nothing
            sums[first + filled] += np.add.reduceat(table.take(rows, axis=0), starts, axis=0)
    z = sums / np.maximum(counts, 1)[:, None] + model.bias
    chances = _softmax(z / model.temperature)
    return chances.max(1), chances.argmax(1)


def train(documents: DataFrame, text: str, lang: str, key: str, limit: int = SAMPLE_ROWS) -> Model:
    """Fit on at most `limit` labelled rows, those whose key and text hash lowest."""
    labelled = documents.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = drawn(labelled, limit, "key", "text", "lang").collect()
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


def identify(documents: DataFrame, model: Model, text: str, keep: list[str]) -> DataFrame:
    """`keep` columns, lang_pred, score, accepted (score reaches the rejection threshold)."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)
    source = documents.select(
        *keep, F.col(text).cast("string").alias("__text"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letters"),
    )
    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)

    def scored(batches):
        model = shared.value
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            score, best = score_batch(model, batch["__text"])
            usable = batch["__letters"].to_numpy(zero_copy_only=False).astype(bool) & bool(model.languages)
            score = np.where(usable, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep),
                 pa.array(names[np.where(usable, best, len(model.languages))], pa.string()),
                 pa.array(score, pa.float64()),
                 pa.array(usable & (score >= model.threshold), pa.bool_())],
                names=[*keep, "lang_pred", "score", "accepted"],
            )

    return source.mapInArrow(scored, f"{schema}, lang_pred string, score double, accepted boolean")
