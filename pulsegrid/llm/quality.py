"""Quality classifier from weak labels.

Heuristic labellers vote good (1), bad (0) or abstain (-1) on each text by the share of signs among its bytes, of
capitals among its letters, of words that start with two capitals, of words that repeat the word before, of words
met before within the same 64 words, of its commonest word, of words that end in two signs or more, and of words
without a letter or digit. They overlap and err. Expectation-maximisation over the counts of vote patterns of all
documents estimates each labeller's accuracies and the share of good documents without any true label; the number
of patterns depends on the labellers, not on the input. The posterior of a document's pattern is its soft label,
and a linear scorer over hashed features is trained on soft labels of a bounded sample. The scorer, not the votes,
decides: it also sees what no labeller names.

Defined results: on texts of fewer than LEAST_WORDS words, null and empty ones too, all labellers abstain; they are
not judged, score the share of good documents, and are kept; an empty table trains nothing and gives an empty
result.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.arrow import Words, chunks, mix, views
from pulsegrid.llm.sample import drawn

#: Most rows that train the scorer (those whose key and text hash lowest).
SAMPLE_ROWS = 8000
BUCKETS, EPOCHS, BATCH, RATE, DECAY = 1 << 14, 12, 64, 0.3, 1e-5
#: Least number of steps: small samples are passed over more often.
LEAST_STEPS = 300
ROUNDS = 200
#: Documents with a lower chance of being good are rejected.
KEEP = 0.5
#: Name of each labeller, and its measure above which it votes bad and below which it votes good.
LABELLERS = (
    ("signs", 0.15, 0.05),
    ("capitals", 0.4, 0.15),
    ("shouting", 0.4, 0.1),
    ("repeats", 0.15, 0.03),
    ("monotony", 0.55, 0.35),
    ("commonest", 0.3, 0.15),
    ("marked", 0.25, 0.03),
    ("bars", 0.1, 0.01),
)
#: Shorter texts get no votes and no measures.
LEAST_WORDS = 5
#: Words among which repeats are counted for monotony.
STRETCH = 64
#: Bins of a measure as a feature.
BINS = np.array([0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.18, 0.25, 0.35, 0.5, 0.7])


def _shapes() -> np.ndarray:
    """Bytes as letters, capitals, digits, blanks, line ends or themselves."""
    shape = np.arange(256, dtype=np.uint32)
    shape[97:123] = shape[128:] = 97
    shape[65:91] = 65
    shape[48:58] = 48
    shape[[9, 11, 12, 32]] = 32
    return shape


_SHAPES = _shapes()
_SIGN = np.zeros(256, bool)
_SIGN[33:48] = _SIGN[58:65] = _SIGN[91:97] = _SIGN[123:127] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_ALPHA = _CAPITAL.copy()
_ALPHA[97:123] = _ALPHA[128:] = True


def _sums(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(flags, dtype=np.int64))[cuts])


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x labellers; not a number where a text has too few words."""
    words = Words(data, offsets)
    hashes = words.hashes(lower=True)
    n = np.diff(words.of)
    some = np.maximum(n, 1)
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    begins = words.of[:-1][n > 0]
    same[begins] = False
    sign = np.append(_SIGN[data], False)
    capital = np.append(_CAPITAL[data], False)
    two = sign[words.end - 1] & sign[words.end - 2] & (words.end - words.start > 2)
    signs_in = np.append(0, np.cumsum(_SIGN[data]))
    bare = (signs_in[words.end] - signs_in[words.start]) == words.end - words.start
    commonest = np.zeros(len(n))
    for i in np.flatnonzero(n > 0):
        own = np.sort(hashes[words.of[i] : words.of[i + 1]])
        runs = np.flatnonzero(np.append(np.append(True, own[1:] != own[:-1]), True))
        commonest[i] = np.diff(runs).max()
    row = np.repeat(np.arange(len(n)), n)
    block = (np.arange(len(hashes)) - words.of[row]) // STRETCH + row * (len(hashes) // STRETCH + 1)
    order = np.lexsort((hashes, block))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (block[order][1:] == block[order][:-1])
    out = np.stack([
        _sums(_SIGN[data], offsets) / np.maximum(np.diff(offsets), 1),
        _sums(_CAPITAL[data], offsets) / np.maximum(_sums(_ALPHA[data], offsets), 1),
        _sums(capital[words.start] & capital[words.start + 1], words.of) / some,
        _sums(same, words.of) / some,
        _sums(again, words.of) / some,
        np.where(n >= 20, commonest / some, 0.0),
        _sums(two, words.of) / some,
        _sums(bare, words.of) / some,
    ], axis=1)
    out[n < LEAST_WORDS] = np.nan
    return out


def votes(measured: np.ndarray) -> np.ndarray:
    bad, good = (np.array([x[i] for x in LABELLERS]) for i in (1, 2))
    return np.where(measured > bad, 0, np.where(measured < good, 1, -1)).astype(np.int8)


def pattern_numbers(cast: np.ndarray) -> np.ndarray:
    """Votes of a text as one number in base 3."""
    return ((cast.astype(np.int64) + 1) * 3 ** np.arange(cast.shape[1])).sum(1)


@dataclass
class LabelModel:
    good: float  # share of good documents
    right: np.ndarray  # chance of a vote for good on a good text, by labeller
    caught: np.ndarray  # chance of a vote for bad on a bad text

    def posterior(self, cast: np.ndarray) -> np.ndarray:
        """Chance that a text is good, given its votes."""
        for_good, for_bad = cast == 1, cast == 0
        yes = np.log(self.good) + (for_good * np.log(self.right) + for_bad * np.log1p(-self.right)).sum(1)
        no = np.log1p(-self.good) + (for_good * np.log1p(-self.caught) + for_bad * np.log(self.caught)).sum(1)
        return 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))


def estimate(cast: np.ndarray, counts: np.ndarray) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns and how many documents cast each."""
    labellers = cast.shape[1]
    # Labellers vote bad only far beyond what prose shows: at first, such a vote is taken to be seldom wrong.
    m = LabelModel(0.8, np.full(labellers, 0.995), np.full(labellers, 0.3))
    if not len(cast):
        return m
    for _ in range(ROUNDS):
        good = m.posterior(cast) * counts
        bad = counts - good
        # One made-up vote of each sort keeps chances off 0 and 1.
        right = ((cast == 1).T @ good + 1) / ((cast != -1).T @ good + 2)
        caught = ((cast == 0).T @ bad + 1) / ((cast != -1).T @ bad + 2)
        share = float((good.sum() + 1) / (counts.sum() + 2))
        moved = abs(share - m.good) + np.abs(right - m.right).max() + np.abs(caught - m.caught).max()
        m = LabelModel(share, right, caught)
        if moved < 1e-9:
            break
    return m


def _features(data: np.ndarray) -> np.ndarray:
    """Bucket of the three shapes that start at each byte."""
    shape = _SHAPES[data]
    if len(shape) < 3:
        return np.zeros(0, np.int64)
    gram = (shape[:-2] << np.uint32(16)) | (shape[1:-1] << np.uint32(8)) | shape[2:]
    return (gram * np.uint32(0x9E3779B1) >> np.uint32(18)).astype(np.int64)


def _bin_features(measured: np.ndarray) -> np.ndarray:
    """Bucket of each measure's bin, texts x labellers."""
    cells = np.arange(measured.shape[1]) * (len(BINS) + 1) + np.searchsorted(BINS, np.nan_to_num(measured))
    return (mix(cells.astype(np.uint64) + np.uint64(1 << 40)) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float


def _bags(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each text, their values, and where each text's begin. Two arrays for all texts, not two a text: the
    driver gives their memory back when they go."""
    rows, shares, cuts = array("i"), array("f"), [0]
    for i in range(len(texts)):
        data, offsets = views(texts[i : i + 1].combine_chunks())
        some, counts = np.unique(_features(data), return_counts=True)
        measured = measures(data, offsets)
        bins = _bin_features(measured)[0] if not np.isnan(measured[0, 0]) else np.zeros(0, np.int64)
        rows.frombytes(np.append(some, bins).astype(np.int32).tobytes())
        shares.frombytes(np.append(counts / max(1, counts.sum()), np.ones(len(bins))).astype(np.float32).tobytes())
        cuts.append(len(rows))
    return np.frombuffer(rows, np.int32), np.frombuffer(shares, np.float32), np.array(cuts)


def fit(texts: pa.ChunkedArray, soft: np.ndarray, seed: int = 5) -> Scorer:
    """Logistic regression on soft labels by stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(BUCKETS), 0.0
    rows, shares, cuts = _bags(texts)
    batches = max(1, -(-len(texts) // BATCH))
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    steps, step = epochs * batches, 0
    for _ in range(epochs if len(texts) else 0):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            bags = [(rows[cuts[i] : cuts[i + 1]], shares[cuts[i] : cuts[i + 1]]) for i in part]
            error = np.array([1 / (1 + np.exp(-np.clip(share @ w[row] + bias, -30, 30))) - soft[i]
                              for i, (row, share) in zip(part, bags, strict=True)]) / len(part)
            rate = RATE * 4 * (1 - step / steps)
            w *= 1 - DECAY * rate
            for (row, share), e in zip(bags, error, strict=True):
                np.subtract.at(w, row, rate * e * share)
            bias -= rate * error.sum()
            step += 1
    return Scorer(w, bias)


def score_batch(scorer: Scorer, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chance of being good, votes, and whether it has the words to be judged, of each text."""
    data, offsets = views(texts)
    out = np.full(len(texts), scorer.bias)
    cast = np.full((len(texts), len(LABELLERS)), -1, np.int8)
    judged = np.zeros(len(texts), bool)
    weights = np.append(scorer.weights, 0.0)
    for first, last in chunks(offsets):
        part, cuts = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        measured = measures(part, cuts)
        cast[first:last] = votes(measured)
        judged[first:last] = ~np.isnan(measured[:, 0])
        out[first:last] += np.where(judged[first:last], scorer.weights[_bin_features(measured)].sum(1), 0.0)
        filled = np.flatnonzero(np.diff(cuts))
        if not len(filled):
            continue
        starts, ends = cuts[:-1][filled], cuts[1:][filled]
        rows = np.full(len(part), BUCKETS, np.int64)
        rows[: max(0, len(part) - 2)] = _features(part)
        for back in (1, 2):
            rows[np.maximum(ends - back, starts)] = BUCKETS
        grams = np.maximum(ends - starts - 2, 1)
        out[first + filled] += np.add.reduceat(weights[rows], starts) / grams
    return 1 / (1 + np.exp(-np.clip(out, -30, 30))), cast, judged


def label_model(documents: DataFrame, text: str) -> LabelModel:
    """Estimated on the vote patterns of all documents; only the pattern counts reach the driver."""

    def cast(batches):
        for batch in batches:
            data, offsets = views(batch["text"])
            found = [pattern_numbers(votes(measures(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])))
                     for a, b in chunks(offsets)]
            numbers, counts = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(counts)], names=["pattern", "n"])

    rows = documents.select(F.col(text).cast("string").alias("text")).mapInArrow(cast, "pattern long, n long")
    counted = rows.groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    patterns = np.array([r["pattern"] for r in counted], np.int64).reshape(-1)
    cast_votes = (patterns[:, None] // 3 ** np.arange(len(LABELLERS))) % 3 - 1
    return estimate(cast_votes, np.array([r["n"] for r in counted], float))


def train(documents: DataFrame, text: str, key: str, limit: int = SAMPLE_ROWS) -> tuple[Scorer, LabelModel]:
    model = label_model(documents, text)
    rows = drawn(
        documents.where(F.col(text).isNotNull()).select(
            F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text")),
        limit, "key", "text",
    )
    texts = rows.select("text").toArrow()["text"]
    cast = [votes(measures(*views(texts[i : i + 1].combine_chunks())))[0] for i in range(len(texts))]
    soft = model.posterior(np.array(cast).reshape(-1, len(LABELLERS)))
    return fit(texts, soft), model


def classify(documents: DataFrame, scorer: Scorer, model: LabelModel, text: str, keep: list[str],
             threshold: float = KEEP) -> DataFrame:
    """`keep` columns, score (chance of being good), posterior (of the votes alone), kept."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((scorer, model))
    source = documents.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = "".join(f"`{c}` {source.schema[c].dataType.simpleString()}, " for c in keep)

    def scored(batches):
        scorer, model = shared.value
        for batch in batches:
            score, cast, judged = score_batch(scorer, batch["__text"])
            score = np.where(judged, score, model.good)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), pa.array(score), pa.array(model.posterior(cast)),
                 pa.array((score >= threshold) | ~judged)],
                names=[*keep, "score", "posterior", "kept"],
            )

    return source.mapInArrow(scored, f"{schema}score double, posterior double, kept boolean")
