"""Substring deduplication with repeated-phrase automata.

A window is `size` consecutive words of one document. A word is removed if a window covers it whose word sequence
also starts in a document with a smaller id; windows are judged on the input.

1. Documents are dealt into shards by a hash of id and text. A shard hashes all its windows and sends each distinct
   hash once, with its least and greatest document: a window that a third of all documents hold arrives once from
   each shard. The entries travel in packed lists, dealt by hash into buckets of bounded size.
2. Confirm: a bucket finds the windows that more than one document holds and answers each shard that holds one in a
   later document with the window and its first document.
3. A shard takes the words of its confirmed windows as phrases, spells each word as one of LETTERS letters, compiles the
   phrases into Aho-Corasick automata of bounded size, and streams all its documents through each: every stretch of
   words that phrases are made of, shorter ones than a window hold no phrase. A hit that is a window of its phrases by
   hash, and whose phrase starts in an earlier document, removes the words that it covers.

Shards and buckets are numbered from the size of the input. The text moves once: both uses of the shards read one
shuffle.

Defined results: null and empty texts have no words; documents with fewer words than a window lose nothing; rows
with a null id are kept whole and count for no other; rows that repeat an id don't remove words from each other;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.arrow import U64, Words, chunks, grams, pack, pack_sorted, unpack, unpack_sorted, views

SIZE = 13
#: Most phrases in one automaton.
PHRASES = 50_000
#: Bytes of text in a shard, and of text whose windows make a bucket.
SHARD_BYTES, BUCKET_BYTES = 3 << 20, 12 << 20
#: Letters that words are spelled with, and bits of a hash that place it in a table of members.
LETTERS, TABLE_BITS = 128, 20
_ID_SHIFT = U64(1 << 63)  # ids as unsigned numbers in the same order


def _windows(table: pa.Table, size: int) -> Iterator[tuple[int, Words, np.ndarray, np.ndarray]]:
    """For each document of a shard its row, the words around it, its word hashes and window hashes."""
    row = 0
    for batch in table.to_batches():
        data, offsets = views(batch["text"])
        for first, last in chunks(offsets):
            words = Words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            hashes = words.hashes()
            windows = grams(hashes, size)
            # No window starts in the last words of a text: those places hold windows that reach into the next.
            for i, (a, b) in enumerate(zip(words.of[:-1].tolist(), words.of[1:].tolist(), strict=True)):
                yield row + first + i, (words, i), hashes[a:b], windows[a : max(a, b - size + 1)]
        row += batch.num_rows


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table["key"].combine_chunks()
    known = ~np.asarray(ids.is_null())
    return ids.fill_null(0).to_numpy().astype(np.int64).view(U64) ^ _ID_SHIFT, known


def _shard_windows(table: pa.Table, size: int, buckets: int) -> pa.Table:
    ids, known = _ids(table)
    found, owners = [np.zeros(0, U64)], [np.zeros(0, U64)]
    for row, _, _, windows in _windows(table, size):
        if known[row] and len(windows):
            found.append(windows)
            owners.append(np.full(len(windows), ids[row]))
    found, owners = np.concatenate(found), np.concatenate(owners)
    order = np.lexsort((owners, found))
    found, owners = found[order], owners[order]
    new = np.append(True, found[1:] != found[:-1])[: len(found)]
    starts = np.flatnonzero(new)
    low = owners[starts]
    high = owners[np.append(starts[1:], len(found)) - 1] if len(starts) else low
    found = found[starts]
    bucket = (found >> U64(32)) * U64(buckets) >> U64(32)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=U64)) if buckets < len(found) else None
    numbers = np.unique(bucket)
    shard = table["shard"][0].as_py()
    rows = []
    for number in numbers.tolist():
        a, b = (cuts[number], cuts[number + 1]) if cuts is not None else np.searchsorted(bucket, [number, number + 1])
        rows.append((number, shard, pack_sorted(found[a:b]), pack(low[a:b] ^ _ID_SHIFT),
                     pack(high[a:b] - low[a:b])))
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                     *(pa.array(c, pa.binary()) for c in columns[2:])],
                    names=["bucket", "shard", "windows", "low", "spread"])


def _confirm(table: pa.Table) -> pa.Table:
    """Windows of a bucket that more than one document holds, for each shard that has one to remove."""
    windows, low, high, shard = [], [], [], []
    for row in table.to_pylist():
        own = unpack_sorted(row["windows"])
        least = unpack(row["low"]) ^ _ID_SHIFT
        windows.append(own)
        low.append(least)
        high.append(least + unpack(row["spread"]))
        shard.append(np.full(len(own), row["shard"], np.int64))
    windows, low, high, shard = (np.concatenate(x) for x in (windows, low, high, shard))
    order = np.lexsort((low, windows))
    windows, low, high, shard = (x[order] for x in (windows, low, high, shard))
    starts = np.flatnonzero(np.append(True, windows[1:] != windows[:-1]))
    first = np.repeat(low[starts], np.diff(np.append(starts, len(windows))))
    later = high > first
    windows, first, shard = windows[later], first[later], shard[later]
    order = np.lexsort((windows, shard))
    windows, first, shard = windows[order], first[order], shard[order]
    numbers, starts = np.unique(shard, return_index=True)
    cuts = np.append(starts, len(shard))
    parts = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pa.table([pa.array(numbers, pa.int64()),
                     pa.array([pack_sorted(windows[a:b]) for a, b in parts], pa.binary()),
                     pa.array([pack(first[a:b] ^ _ID_SHIFT) for a, b in parts], pa.binary())],
                    names=["shard", "windows", "first"])


class _Members:
    """Tells which hashes are in a sorted array. A table of bits by their first bits rules out most of the others."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.bits = np.zeros(1 << TABLE_BITS, bool)
        self.bits[values >> U64(64 - TABLE_BITS)] = True

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of members in `hashes`, and where they are in the array."""
        maybe = np.flatnonzero(self.bits[hashes >> U64(64 - TABLE_BITS)])
        at = np.minimum(np.searchsorted(self.values, hashes[maybe]), len(self.values) - 1)
        real = self.values[at] == hashes[maybe]
        return maybe[real], at[real]


def _spelled(words: np.ndarray) -> str:
    """Word hashes as a letter each. Few letters keep the nodes of an automaton from having very many children."""
    return (words % U64(LETTERS) + U64(1)).astype("<u4").tobytes().decode("utf-32-le")


def _stretches(words: np.ndarray, vocabulary: _Members, size: int) -> list[tuple[int, int]]:
    """Stretches of `size` or more words of the vocabulary."""
    known, _ = vocabulary.places(words)
    if len(known) < size:
        return []
    cuts = np.flatnonzero(np.diff(known) != 1) + 1
    starts, ends = known[np.append(0, cuts)], known[np.append(cuts, len(known)) - 1] + 1
    long = ends - starts >= size
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def _automata(documents: list, size: int, confirmed: np.ndarray):
    """Automata over the confirmed windows, PHRASES at most in each: the automaton, its windows and its vocabulary.
    Phrases spelled alike are one entry of the automaton."""
    for start in range(0, len(confirmed), PHRASES):
        part = _Members(confirmed[start : start + PHRASES])
        phrases = np.zeros((len(part.values), size), U64)
        for _, _, own, windows in documents:
            places, at = part.places(windows)
            if len(places):
                phrases[at] = own[places[:, None] + np.arange(size)]
        spelled = _spelled(phrases.ravel())
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for i in range(0, len(spelled), size):
            automaton.add_word(spelled[i : i + size])
        automaton.make_automaton()
        yield automaton, part, _Members(np.unique(phrases))


def _strip(table: pa.Table, phrases: pa.Table, size: int) -> pa.Table:
    ids, known = _ids(table)
    confirmed = np.concatenate([np.zeros(0, U64), *(unpack_sorted(x.as_py()) for x in phrases["windows"])])
    first = np.concatenate([np.zeros(0, U64), *(unpack(x.as_py()) ^ _ID_SHIFT for x in phrases["first"])])
    order = np.argsort(confirmed)
    confirmed, first = confirmed[order], first[order]
    covered: dict[int, list[np.ndarray]] = {}
    documents = list(_windows(table, size))
    before = 0
    for automaton, part, vocabulary in _automata(documents, size, confirmed):
        own_first = first[before : before + len(part.values)]
        before += len(part.values)
        for row, _, own, windows in documents:
            if known[row] and len(windows):
                hits = [a + end - size + 1 for a, b in _stretches(own, vocabulary, size)
                        for end, _ in automaton.iter(_spelled(own[a:b]))]
                if hits:
                    starts = np.array(hits, np.int64)
                    # The spelling holds for the window; its hash must agree as well.
                    real, which = part.places(windows[starts])
                    covered.setdefault(row, []).append(starts[real[own_first[which] < ids[row]]])
    counts, removed, digests, kept_texts = [], [], [], []
    for row, (words, i), own, _ in documents:
        gone = np.zeros(len(own) + 1, np.int32)
        for starts in covered.get(row, ()):
            np.add.at(gone, starts, 1)
            np.add.at(gone, starts + size, -1)
        keep = np.cumsum(gone[:-1]) == 0
        text = _joined(words, words.of[i], keep)
        counts.append(len(own))
        removed.append(len(own) - int(keep.sum()))
        digests.append(hashlib.sha256(text).hexdigest())
        kept_texts.append(text)
    return pa.table([table["key"].cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(digests, pa.string()), pa.array(kept_texts, pa.binary()).cast(pa.string())],
                    names=["key", "n_words", "n_removed", "kept_sha256", "kept_text"])


def _joined(words: Words, first: int, keep: np.ndarray) -> bytes:
    """The kept words of a text, by one blank each."""
    starts, ends = words.start[first : first + len(keep)][keep], words.end[first : first + len(keep)][keep]
    if not len(starts):
        return b""
    a, b = int(starts[0]), int(ends[-1])
    use = np.zeros(b - a + 1, np.int8)
    use[starts - a] += 1
    use[ends - a] -= 1
    inside = np.cumsum(use[:-1]) > 0
    out = words.data[a:b].copy()
    # One byte behind each word but the last becomes the blank; the words of a text are never adjacent.
    out[ends[:-1] - a] = 32
    inside[ends[:-1] - a] = True
    return out[inside].tobytes()


def dedup_phrases(documents: DataFrame, key: str, text: str, size: int = SIZE, shard_bytes: int = SHARD_BYTES,
                  bucket_bytes: int = BUCKET_BYTES, with_text: bool = True) -> DataFrame:
    """key, n_words, n_removed, kept_sha256 and kept_text (kept words joined by one blank) of each document."""
    total = documents.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    shards, buckets = int(total // shard_bytes + 1), int(total // bucket_bytes + 1)
    rows = documents.select(
        F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(key), F.col(text).cast("string")), F.lit(shards)).alias("shard"),
    ).repartition("shard")
    sent = rows.groupBy("shard").applyInArrow(
        lambda t: _shard_windows(t, size, buckets),
        "bucket long, shard long, windows binary, low binary, spread binary")
    answers = sent.groupBy("bucket").applyInArrow(_confirm, "shard long, windows binary, first binary")

    def strip(table: pa.Table, phrases: pa.Table) -> pa.Table:
        out = _strip(table, phrases, size)
        return out if with_text else out.drop_columns("kept_text")

    kept = ", kept_text string" if with_text else ""
    return rows.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(
        strip, f"key long, n_words long, n_removed long, kept_sha256 string{kept}")
