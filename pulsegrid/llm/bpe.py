"""Byte-level byte-pair encoding with a hierarchical-bitmap rank queue, and decoding.

A text is cut into pre-tokens by a pattern. A pre-token that is a vocabulary entry is that entry; any other is
merged from single bytes: the adjacent pair whose union ranks lowest is joined, the leftmost first among equals,
until no pair is in the vocabulary.

The queue holds the left positions of joinable pairs in buckets by rank. Three levels of bitmaps say which buckets
are filled (a bit of a level stands for 64 bits of the level below), so the lowest filled bucket is found by three
find-first-set steps however long the pre-token is. Neighbours are a linked list. A merge changes the pairs at both
sides; their old entries stay in the queue and are skipped when reached, because the pair at that position has
another rank by then. The work is close to linear in a pre-token's length, where rescanning all pairs would be
quadratic in long runs. Pre-tokens that are new in a batch of texts share one queue: their bytes lie end to end in
one list of positions, and no pair reaches over a border. A worker remembers the ids of pre-tokens it has met,
by hash; a text whose ids don't decode to itself is encoded again without that memory.

Defined results: a null text encodes as the empty text (no ids); a byte that is no vocabulary entry, or an id out
of range when decoding, is an error, as neither can come from a complete byte-level vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.arrow import Words, chunks, views

#: Pre-tokens whose ids a worker remembers, about 50 bytes each. Results don't depend on it.
REMEMBERED = 1_000_000
#: Bytes of text that are encoded at a time; a longer text is encoded alone.
STEP_BYTES = 1 << 21
#: The pattern that `marks` finds the matches of; texts are cut by other patterns with regex.
WORDS_NUMBERS_SIGNS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_SPACE, _LETTER, _NUMBER, _SIGN = range(4)


class RankQueue:
    """Lists of positions by rank, the lowest filled rank first."""

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.low: dict[int, int] = {}
        self.mid: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.put(rank, [position])
        else:
            bucket.append(position)

    def put(self, rank: int, positions: list[int]) -> None:
        """Fill an empty bucket."""
        self.buckets[rank] = positions
        word = rank >> 6
        group = word >> 6
        self.low[word] = self.low.get(word, 0) | 1 << (rank & 63)
        self.mid[group] = self.mid.get(group, 0) | 1 << (word & 63)
        self.top |= 1 << group

    def take(self) -> tuple[int, list[int]] | None:
        """Empty the lowest filled bucket."""
        top = self.top
        if not top:
            return None
        group = (top & -top).bit_length() - 1
        bits = self.mid[group]
        word = (group << 6) + (bits & -bits).bit_length() - 1
        bits = self.low[word]
        lowest = bits & -bits
        rank = (word << 6) + lowest.bit_length() - 1
        self.low[word] = bits = bits ^ lowest
        if not bits:
            self.mid[group] ^= 1 << (word & 63)
            if not self.mid[group]:
                self.top ^= 1 << group
        return rank, self.buckets.pop(rank)


@cache
def _kinds() -> np.ndarray:
    """Kind of each code point."""
    kinds = np.full(0x110000, _SIGN, np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, expression in ((_SPACE, r"\s+"), (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for found in regex.finditer(expression, everything):
            points = np.frombuffer(found[0].encode("utf-32-le"), np.uint32)
            kinds[points] = kind
    return kinds


def marks(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a match of WORDS_NUMBERS_SIGNS starts. `points` are the code points of some texts on end and
    `first` is true at the first of each text. Every character is in a match, so starts say it all."""
    kind = _kinds()[points]
    n = len(points)
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # The last character of white space before anything else: a blank belongs to what follows, others stand alone.
    after = np.flatnonzero((kind[1:] != _SPACE) & (kind[:-1] == _SPACE) & ~first[1:]) + 1
    start[after - 1] = True
    start[after[points[after - 1] == 32]] = False
    # An apostrophe that starts a match and one of seven endings.
    quote = np.flatnonzero(start & (points == 39))
    if len(quote):
        padded = np.append(points, [0, 0]).astype(np.uint32)
        ends = np.append(first, [True, True])
        one, two = padded[quote + 1], padded[quote + 2]
        near, far = ~ends[quote + 1], ~ends[quote + 1] & ~ends[quote + 2]
        single = near & np.isin(one, [ord(x) for x in "stmd"])
        pair = one.astype(np.int64) << 32 | two
        double = far & np.isin(pair, [ord(x[0]) << 32 | ord(x[1]) for x in ("re", "ve", "ll")])
        for places, length in ((quote[single], 2), (quote[double], 3)):
            start[places + 1] = False
            rest = places + length
            rest = rest[rest < n]
            start[rest[(kind[rest] == _LETTER) & ~first[rest]]] = True
    return start


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[s:s + n] for each start and length, on end."""
    total = np.cumsum(lengths)
    if not len(total) or not total[-1]:
        return values[:0]
    return values[np.repeat(starts - total + lengths, lengths) + np.arange(total[-1])]


class Pieces(Words):
    """Pre-tokens of some texts as byte ranges."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, split, pattern: str):
        self.data = data
        if pattern == WORDS_NUMBERS_SIGNS:
            text = data.tobytes().decode()
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            at = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each character
            first = np.zeros(len(points), bool)
            begins = np.searchsorted(at, offsets[:-1])
            first[begins[begins < len(points)]] = True
            self.start = at[marks(points, first)]
            self.end = np.append(self.start[1:], len(data))
        else:
            starts, ends = [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                text, read = data[a:b].tobytes().decode(), 0
                for match in split(text):
                    a += len(text[read : match.start()].encode())
                    starts.append(a)
                    a += len(match[0].encode())
                    ends.append(a)
                    read = match.end()
            self.start, self.end = np.array(starts, np.int64), np.array(ends, np.int64)
        self.of = np.searchsorted(self.start, offsets)


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = pattern
        self.split = regex.compile(pattern).finditer
        size = max(ranks.values(), default=-1) + 1
        tokens, texts = [b""] * size, [b""] * size
        for token, i in ranks.items():
            tokens[i], texts[i] = token, b"%d," % i
        self.token_bytes, self.token_starts, self.token_lengths = _flat(tokens)
        self.digits, self.digit_starts, self.digit_lengths = _flat(texts)
        self.pairs = np.full(1 << 16, -1, np.int32)  # ranks of two bytes
        for token, i in ranks.items():
            if len(token) == 2:
                self.pairs[token[0] << 8 | token[1]] = i
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of pre-tokens that are no vocabulary entries."""
        rank_of = self.ranks.get
        data = b"".join(pieces)
        n = len(data)
        ends = list(range(1, n + 1))  # where the part at a position ends: the next part, or a border
        before = list(range(-1, n - 1))
        pair: list[int | None] = [None] * n  # rank of the part at a position joined with the next
        border = bytearray(n + 1)
        at = 0
        for piece in pieces:
            border[at] = 1
            at += len(piece)
        border[n] = 1
        queue = RankQueue()
        push = queue.push
        codes = np.frombuffer(data, np.uint8).astype(np.int64)
        ranks = np.append(self.pairs[codes[:-1] << 8 | codes[1:]], -1)
        ranks[np.flatnonzero(np.frombuffer(border, np.uint8)[1:])] = -1
        places = np.flatnonzero(ranks >= 0)
        for i, rank in zip(places.tolist(), ranks[places].tolist(), strict=True):
            pair[i] = rank
            push(rank, i)
        while (found := queue.take()) is not None:
            rank, positions = found
            positions.sort()
            for k, left in enumerate(positions):
                if pair[left] != rank:
                    continue  # stale
                right = ends[left]
                after = ends[left] = ends[right]
                pair[right] = None
                lower = False
                if border[after]:
                    pair[left] = None
                    if after < n:
                        before[after] = left
                else:
                    before[after] = left
                    new = pair[left] = rank_of(data[left : ends[after]])
                    if new is not None:
                        push(new, left)
                        lower = new < rank
                if not border[left]:
                    previous = before[left]
                    new = pair[previous] = rank_of(data[previous:after])
                    if new is not None:
                        push(new, previous)
                        lower = lower or new < rank
                if lower and k + 1 < len(positions):  # a pair that ranks lower has come up: it goes first
                    queue.put(rank, positions[k + 1 :])
                    break
        out, at = [], 0
        for piece in pieces:
            ids, end = [], at + len(piece)
            while at < end:
                ids.append(rank_of(data[at : ends[at]]))
                at = ends[at]
            if None in ids:
                raise ValueError("the vocabulary lacks a byte")
            out.append(tuple(ids))
        return out

    def learn(self, hashes: np.ndarray, tokens: list[bytes]) -> None:
        """Remember the ids of pre-tokens, given with their hashes in ascending order."""
        found: list[tuple[int, ...]] = [()] * len(tokens)
        new = []
        for i, token in enumerate(tokens):
            rank = self.ranks.get(token)
            if rank is None:
                new.append(i)
            else:
                found[i] = (rank,)
        for i, ids in zip(new, self.merge([tokens[i] for i in new]) if new else (), strict=True):
            found[i] = ids
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        where = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, where, hashes)
        self.at = np.insert(self.at, where, len(self.ids) + np.cumsum(lengths) - lengths)
        self.lengths = np.insert(self.lengths, where, lengths)
        self.ids = np.append(self.ids, np.fromiter((i for x in found for i in x), np.int32, int(lengths.sum())))

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts on end, and where those of each text start."""
        pieces = Pieces(data, offsets, self.split, self.pattern)
        hashes = pieces.hashes()
        distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.hashes, distinct)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == distinct[known]
        if not known.all():
            examples = example[~known]
            raw = data.tobytes()
            self.learn(distinct[~known], [raw[a:b] for a, b in
                                          zip(pieces.start[examples].tolist(), pieces.end[examples].tolist(),
                                              strict=True)])
            at = np.searchsorted(self.hashes, distinct)
        lengths = self.lengths[at][which]
        ids = _gather(self.ids, self.at[at][which], lengths)
        return ids, np.append(0, np.cumsum(lengths))[pieces.of]

    def decode_ids(self, ids: np.ndarray) -> bytes:
        return _gather(self.token_bytes, self.token_starts[ids], self.token_lengths[ids]).tobytes()

    def decimal(self, ids: np.ndarray) -> bytes:
        return _gather(self.digits, self.digit_starts[ids], self.digit_lengths[ids]).tobytes()[:-1]

    def encode_views(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        ids, starts = self.encode_bytes(data, offsets)
        out = [ids[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        for i, found in enumerate(out):
            if self.token_lengths[found].sum() != offsets[i + 1] - offsets[i]:
                out[i] = self.encode_alone(data[offsets[i] : offsets[i + 1]].tobytes())
        return out

    def encode_alone(self, text: bytes) -> np.ndarray:
        """Ids of one text without the memory of pre-tokens."""
        data = np.frombuffer(text, np.uint8)
        pieces = Pieces(data, np.array([0, len(data)]), self.split, self.pattern)
        out = []
        for a, b in zip(pieces.start.tolist(), pieces.end.tolist(), strict=True):
            rank = self.ranks.get(text[a:b])
            out += self.merge([text[a:b]])[0] if rank is None else [rank]
        return np.array(out, np.int32)

    def encode(self, text: str) -> list[int]:
        data, offsets = views(pa.array([text]))
        return self.encode_views(data, offsets)[0].tolist()

    def decode(self, ids: list[int]) -> bytes:
        return self.decode_ids(np.array(ids, np.int64))


def _flat(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(v) for v in values], np.int64)
    return np.frombuffer(b"".join(values), np.uint8), np.cumsum(lengths) - lengths, lengths


@cache
def encoder(path: str, pattern: str) -> Encoder:
    """One a worker. `path` is a file of base64 token and rank a line, present on every executor."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return Encoder({base64.b64decode(p[0]): int(p[1]) for p in pairs if p}, pattern)


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _schema(source: DataFrame, keep: list[str]) -> str:
    return "".join(f"`{c}` {source.schema[c].dataType.simpleString()}, " for c in keep)


def encode(documents: DataFrame, path: str, pattern: str, text: str, keep: list[str],
           with_ids: bool = True) -> DataFrame:
    """`keep` columns, ids (list, unless left out), n_tokens, ids_sha256, decoded_sha256.

    Each text is encoded whole and its ids are decoded again to bytes.
    """
    source = documents.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))

    def encoded(batches):
        worker = encoder(path, pattern)
        for whole in batches:
            data, offsets = views(whole["__text"])
            for first, last in chunks(offsets, STEP_BYTES):
                batch = whole.slice(first, last - first)
                part, cuts = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                found = worker.encode_views(part, cuts)
                back = [worker.decode_ids(ids) for ids in found]
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    text = part[a:b].tobytes()
                    if back[i] != text:
                        found[i] = worker.encode_alone(text)
                        back[i] = worker.decode_ids(found[i])
                sizes = np.array([0, *map(len, found)])
                made = {}
                if with_ids:
                    made["ids"] = pa.ListArray.from_arrays(
                        pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(found), pa.int32()))
                made["n_tokens"] = pa.array(sizes[1:], pa.int64())
                made["ids_sha256"] = pa.array([_sha256(worker.decimal(ids)) for ids in found])
                made["decoded_sha256"] = pa.array([_sha256(b) for b in back])
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), *made.values()], names=[*keep, *made])

    ids = "ids array<int>, " if with_ids else ""
    return source.mapInArrow(
        encoded,
        f"{_schema(source, keep)}{ids}n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


def decode(encoded: DataFrame, path: str, pattern: str, ids: str, keep: list[str]) -> DataFrame:
    """`keep` columns and text_bytes, the bytes that the list of ids stands for (null list: none)."""
    source = encoded.select(*keep, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("__ids"))

    def decoded(batches):
        worker = encoder(path, pattern)
        for batch in batches:
            out = [worker.decode(x) for x in batch["__ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(out, pa.binary())],
                                             names=[*keep, "text_bytes"])

    return source.mapInArrow(decoded, f"{_schema(source, keep)}text_bytes binary")
