"""Words, n-grams and hashes of Arrow text columns, whole columns at a time in numpy.

Words are maximal runs of characters other than space and U+0009..U+000D. Hashes are 64 bits: a polynomial
over a table of random byte values, mixed once per word, then a polynomial over word hashes, mixed again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_GRAM = U64(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def views(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and the offset of each text in them. Null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes; a longer text is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, min(end, rows)
        row = end


class Words:
    """Words of some texts: `start` and `end` byte of each, and `of[i]:of[i + 1]` are the words of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        space = (data == 32) | ((data >= 9) & (data <= 13))
        inside = ~space
        first, last = inside.copy(), inside.copy()
        first[1:] &= space[:-1]
        last[:-1] &= space[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        first[cuts] |= inside[cuts]
        last[cuts - 1] |= inside[cuts - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.of = np.searchsorted(self.start, offsets)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One hash a word; `lower` reads A-Z as a-z."""
        powers, inverse = _tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, U64)
        np.cumsum((_LOWER if lower else _BYTES)[self.data] * powers[: len(self.data)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start])


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k consecutive word hashes; empty if there are fewer."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for i in range(k):
        out = out * _GRAM + hashes[i : n + i]
    return mix(out ^ U64(k))


def pack(values: np.ndarray) -> bytes:
    """Integers as zstd over their byte planes; sorted values should come as differences."""
    raw = values.astype(np.uint64, copy=False).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    if not size:
        return np.zeros(0, U64)
    raw = pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(U64).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=U64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=U64)
