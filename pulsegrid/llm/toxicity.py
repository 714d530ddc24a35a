"""Toxicity: a factorisation machine over hashed terms.

A text's terms are its words with A-Z folded and ASCII signs at either end cut off, hashed to 64 bits, each with
the weight log2(1 + count). The machine's answer is

    bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

so it learns what a term means alone and what two terms mean together: one insult quoted once may be harmless
where the same insult beside a second one, or beside a group's name, is not. It is fitted in numpy on a bounded
sample of labelled rows. Only terms whose presence says something about the label get weights: alone (largest
chi-square), or together with another term (largest chi-square of the pair beyond what both tell alone, over the PAIRED
most frequent terms); the others are zero, whatever the length of a text, so a long text is not judged by its many words.

Defined results: null and empty texts have no terms and score the bias; rows without a label or text are not
learned from; without rows of both labels every text scores the share of toxic rows (0 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.arrow import Words, chunks, views
from pulsegrid.llm.sample import drawn

#: Most labelled rows that training reads, and most terms that get weights.
SAMPLE_ROWS, TERMS = 8000, 1024
FACTORS, EPOCHS, BATCH, RATE, LEAST_ROWS, LEAST_CHI = 8, 120, 64, 0.08, 8, 25.0
#: Frequent terms whose pairs are looked at, pairs that are admitted at most, and the excess that a pair needs.
PAIRED, PAIRS, LEAST_PAIR_CHI = 1024, 128, 60.0
#: Share of held-back training rows used to choose the number of passes.
_HELD = 5


@dataclass
class Machine:
    terms: np.ndarray  # sorted hashes
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # terms x factors


def _trimmed(words: Words) -> Words:
    """Cuts ASCII signs from both ends of each word; a word of signs only becomes empty and is dropped."""
    sign = np.zeros(256, bool)
    sign[33:48] = sign[58:65] = sign[91:97] = sign[123:127] = True
    is_sign = np.append(sign[words.data], False)
    at = np.arange(len(is_sign))
    following = np.minimum.accumulate(np.where(is_sign, len(is_sign), at)[::-1])[::-1]
    before = np.maximum.accumulate(np.where(is_sign, -1, at))
    words.start = np.minimum(following[words.start], words.end)
    words.end = np.maximum(before[words.end - 1] + 1, words.start)
    return words


def terms_of(texts: pa.Array):
    """For each run of rows: first row, text number of each term, hash of each term, in order of occurrence."""
    data, offsets = views(texts)
    for first, last in chunks(offsets):
        words = _trimmed(Words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]))
        rows = np.repeat(np.arange(last - first), np.diff(words.of))
        hashes = words.hashes(lower=True)
        some = words.end > words.start
        yield first, last, rows[some], hashes[some]


def weights(counts: np.ndarray) -> np.ndarray:
    return np.log2(1.0 + counts)


def _logit(m: Machine, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, m.bias)
    if len(rows):
        out += np.bincount(rows, values * m.linear[columns], n)
        for f in range(m.factors.shape[1]):
            part = values * m.factors[columns, f]
            out += 0.5 * (np.bincount(rows, part, n) ** 2 - np.bincount(rows, part * part, n))
    return out


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _telling_pairs(row_of: np.ndarray, at: np.ndarray, seen: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Terms of the pairs whose presence together says much more about the label than both of their presences alone."""
    frequent = np.argsort(-seen, kind="stable")[:PAIRED]
    frequent = frequent[(seen[frequent] >= LEAST_ROWS) & (seen[frequent] <= len(labels) - LEAST_ROWS)]
    if len(frequent) < 2:
        return np.zeros(0, np.int64)
    place = np.full(len(seen), -1)
    place[frequent] = np.arange(len(frequent))
    x = np.zeros((len(labels), len(frequent)), np.float32)
    known = place[at] >= 0
    x[row_of[known], place[at[known]]] = 1
    both, toxic = (x.T @ x).astype(float), (x.T @ (x * labels[:, None].astype(np.float32))).astype(float)
    n, one, bad = len(labels), np.diag(both), np.diag(toxic)
    # Rows with both, one or none of two terms, and the toxic ones among them. What both tell alone is the best additive
    # law; what is left is the difference of differences of the four shares.
    cells = [both, one[:, None] - both, one[None, :] - both, n - one[:, None] - one[None, :] + both]
    marked = [toxic, bad[:, None] - toxic, bad[None, :] - toxic, labels.sum() - bad[:, None] - bad[None, :] + toxic]
    share = [m / np.maximum(c, 1) for m, c in zip(marked, cells, strict=True)]
    mixed = share[0] - share[1] - share[2] + share[3]
    mean = labels.mean() * (1 - labels.mean())
    excess = mixed**2 / (mean * sum(1 / np.maximum(c, 1e-9) for c in cells))
    excess[np.minimum.reduce(cells) < LEAST_ROWS] = 0
    excess = np.triu(excess, 1)
    order = np.argsort(-excess, axis=None, kind="stable")[:PAIRS]
    order = order[excess.ravel()[order] > LEAST_PAIR_CHI]
    return np.unique(frequent[np.concatenate(np.unravel_index(order, excess.shape))])


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, terms: int = TERMS, seed: int = 3) -> Machine:
    """`bags` are distinct hashes and counts of each text; `labels` are 0 or 1."""
    labels = np.asarray(labels, float)
    share = labels.mean() if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Machine(np.zeros(0, np.uint64), -40.0 if not share else 40.0, np.zeros(0), np.zeros((0, FACTORS)))
    hashes = np.concatenate([b[0] for b in bags])
    row_of = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    known, at = np.unique(hashes, return_inverse=True)
    seen = np.bincount(at, minlength=len(known)).astype(float)
    toxic = np.bincount(at, labels[row_of], len(known))
    excess = (toxic - seen * share) ** 2 / (seen * share * (1 - share))
    excess[seen < LEAST_ROWS] = 0
    alone = np.argsort(-excess, kind="stable")[: min(terms, int((excess > LEAST_CHI).sum()))]
    chosen = np.union1d(alone, _telling_pairs(row_of, at, seen, labels))
    m = Machine(known[chosen], float(np.log(share / (1 - share))), np.zeros(len(chosen)),
                np.random.default_rng(seed).normal(0, 0.02, (len(chosen), FACTORS)))
    if not len(chosen):
        return m
    place = np.full(len(known), -1)
    place[chosen] = np.arange(len(chosen))
    x = np.zeros((len(bags), len(chosen)), np.float64)
    column = place[at]
    x[row_of[column >= 0], column[column >= 0]] = weights(np.concatenate([b[1] for b in bags])[column >= 0])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(bags))
    held, learned = order[: len(order) // _HELD], order[len(order) // _HELD :]
    params = [np.array([m.bias]), m.linear, m.factors]
    squares = [np.full_like(p, 1e-6) for p in params]
    best, kept = np.inf, [p.copy() for p in params]
    for _ in range(EPOCHS):
        learned = rng.permutation(learned)
        for start in range(0, len(learned), BATCH):
            rows = learned[start : start + BATCH]
            xs, sums = x[rows], x[rows] @ params[2]
            z = params[0][0] + xs @ params[1] + 0.5 * (sums**2 - xs**2 @ params[2] ** 2).sum(1)
            error = (_chance(z) - labels[rows]) / len(rows)
            grads = [np.array([error.sum()]), xs.T @ error + 2e-4 * params[1],
                     xs.T @ (error[:, None] * sums) - params[2] * ((xs**2).T @ error)[:, None] + 1e-3 * params[2]]
            for p, s, g in zip(params, squares, grads, strict=True):
                s += g * g
                p -= RATE * g / np.sqrt(s)
        sums = x[held] @ params[2]
        z = params[0][0] + x[held] @ params[1] + 0.5 * (sums**2 - x[held] ** 2 @ params[2] ** 2).sum(1)
        p = np.clip(_chance(z), 1e-6, 1 - 1e-6)
        loss = -(labels[held] * np.log(p) + (1 - labels[held]) * np.log(1 - p)).mean() if len(held) else 0.0
        if loss < best:
            best, kept = loss, [q.copy() for q in params]
    m.bias, m.linear, m.factors = float(kept[0][0]), kept[1], kept[2]
    return m


def score_batch(m: Machine, texts: pa.Array) -> np.ndarray:
    out = np.full(len(texts), m.bias)
    if len(m.terms):
        for first, last, rows, hashes in terms_of(texts):
            at = np.minimum(np.searchsorted(m.terms, hashes), len(m.terms) - 1)
            known = m.terms[at] == hashes
            cells, counts = np.unique(rows[known] * len(m.terms) + at[known], return_counts=True)
            out[first:last] = _logit(m, cells // len(m.terms), cells % len(m.terms), weights(counts), last - first)
    return _chance(out)


def bags_of(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for first, last, rows, hashes in terms_of(pa.array(texts, pa.string())):
        cuts = np.searchsorted(rows, np.arange(last - first + 1))
        out += [np.unique(hashes[a:b], return_counts=True) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


def train(labelled: DataFrame, text: str, label: str, key: str, limit: int = SAMPLE_ROWS) -> Machine:
    """Fit on at most `limit` labelled rows, those whose key and text hash lowest."""
    known = labelled.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    rows = drawn(known, limit, "key", "text", "label").collect()
    return fit(bags_of([r["text"] for r in rows]), np.array([min(1, max(0, r["label"])) for r in rows]))


def score(documents: DataFrame, machine: Machine, text: str, keep: list[str]) -> DataFrame:
    """`keep` columns and score, the chance of label 1."""
    shared = documents.sparkSession.sparkContext.broadcast(machine)
    source = documents.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)

    def scored(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), pa.array(score_batch(shared.value, batch["__text"]), pa.float64())],
                names=[*keep, "score"],
            )

    return source.mapInArrow(scored, f"{schema}, score double")
