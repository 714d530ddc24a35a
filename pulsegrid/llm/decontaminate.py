"""Benchmark decontamination by pigeonhole edit matching.

A test item may occur in a document with up to k edits, k = ERROR_SHARE of its length. Cut into k + 1 pieces, an
occurrence with at most k edits leaves at least one piece untouched. So the pieces of all items go into one
Aho-Corasick automaton, every document is streamed through it, and only around exact piece hits the whole item is
compared, with Myers' bit-parallel edit distance: the least distance between the item and any stretch of the
window around the hit. Chance hits are dropped early by the same argument: j neighbouring pieces with j - 1 edits or
fewer hold a half with fewer edits than pieces, so a hit climbs a tree of halves, and the item is compared whole only
if every part on the way up is found within its own budget. Nothing within the budget is missed and nothing beyond
it is reported.

Items and texts are compared in lower case and with runs of white space read as one blank; positions are given in
the text as it is. Items are a stated query set: they are taken in blocks of bounded size, each block broadcast to a
pass over all documents.

A short item leaves no room for edits: below SHORT characters after folding it has none, is one piece, and counts where it
stands between other than letters and digits. Of fewer than SHORT_WORDS words it says nothing inside a text; it counts
where it is the whole text.

Defined results: null and empty texts match nothing; items that are null or empty after folding are not
searched; items with equal texts are each reported; repeated
rows are each reported; empty tables give an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits allowed for each character of an item.
ERROR_SHARE = 0.1
#: Characters below which an item allows no edits, and words below which it must be the whole text.
SHORT, SHORT_WORDS = 40, 3
#: Characters of items in one broadcast block.
BLOCK_CHARS = 2_000_000
MATCHES = "array<struct<item_id:bigint,start:int,end:int,distance:int>>"


def folded(text: str) -> str:
    return " ".join(text.lower().split())


def origins(text: str) -> list[int]:
    """For each character of folded(text) its position in the text, and the text's length."""
    out, blank = [], False
    for i, char in enumerate(text):
        if char.isspace():
            blank = bool(out)
            continue
        if blank:
            out.append(i - 1)
            blank = False
        out += [i] * len(char.lower())
    return out


@dataclass
class Item:
    text: str
    ids: list[int]

    @property
    def short(self) -> bool:
        return len(self.text) < SHORT

    @property
    def budget(self) -> int:
        return 0 if self.short else int(len(self.text) * ERROR_SHARE)

    def stands(self, text: str, start: int) -> bool:
        """Whether a short item counts where it was found in a folded text."""
        end = start + len(self.text)
        if self.text.count(" ") + 1 < SHORT_WORDS:
            return len(self.text) == len(text)
        return not (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()) if start else \
            not text[end : end + 1].isalnum()

    def pieces(self) -> Iterator[tuple[int, str, list[tuple[int, int, int]]]]:
        """Budget + 1 pieces of nearly equal length: place, text, and the parts around it from small to large (start,
        end and budget in the item; the whole item is left out)."""
        n = self.budget + 1
        cuts = [len(self.text) * i // n for i in range(n + 1)]
        for i in range(n):
            low, high, around = 0, n, []
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (low, middle) if i < middle else (middle, high)
                if high - low > 1:
                    around.append((cuts[low], cuts[high], high - low - 1))
            yield cuts[i], self.text[cuts[i] : cuts[i + 1]], around[::-1]


def _places(pattern: str) -> dict[str, int]:
    where: dict[str, int] = defaultdict(int)
    for i, char in enumerate(pattern):
        where[char] |= 1 << i
    return dict(where)


def distances(places: dict[str, int], m: int, text: str) -> Iterator[int]:
    """For each end in the text, the least edit distance of a pattern of length m, given by the places of its
    characters, to a stretch that ends there (Myers)."""
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    for char in text:
        equal = places.get(char, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(across | plus))
        down = plus & across
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up <<= 1
        plus = (down << 1 | ~(vertical | up)) & full
        minus = up & vertical & full
        yield score


def near(places: dict[str, int], m: int, budget: int, text: str) -> bool:
    return any(d <= budget for d in distances(places, m, text))


def occurrences(item: str, budget: int, window: str) -> Iterator[tuple[int, int, int]]:
    """Start, end and distance of the best stretch in each run of ends within the budget."""
    best: tuple[int, int] | None = None
    ends = list(distances(_places(item), len(item), window))
    for end, score in enumerate([*ends, budget + 1]):
        if score <= budget:
            if best is None or score < best[0]:
                best = score, end + 1
        elif best is not None:
            score, stop = best
            back = window[max(0, stop - len(item) - budget) : stop][::-1]
            lengths = [n + 1 for n, d in enumerate(distances(_places(item[::-1]), len(item), back)) if d == score]
            yield stop - min(lengths, key=lambda n: abs(n - len(item))), stop, score
            best = None


class Matcher:
    def __init__(self, items: list[Item]):
        self.items = items
        places = defaultdict(list)
        for number, item in enumerate(items):
            for at, piece, around in item.pieces():
                parts = [(a, b, k, _places(item.text[a:b])) for a, b, k in around]
                places[piece].append((number, at, parts))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[dict]:
        clean = folded(text)
        starts, exact = defaultdict(set), []
        if self.items:
            for end, (size, found) in self.automaton.iter(clean):
                for number, at, parts in found:
                    start = end + 1 - size - at
                    if self.items[number].short:
                        if self.items[number].stands(clean, start):
                            exact.append((number, start))
                    elif start not in starts[number] and all(
                        near(part, b - a, k, clean[max(0, start + a - k) : max(0, start + b + k)])
                        for a, b, k, part in parts
                    ):
                        starts[number].add(start)
        out, back = [], None
        for number, start in exact:
            back = origins(text) if back is None else back
            span = {"start": back[start], "end": back[start + len(self.items[number].text) - 1] + 1, "distance": 0}
            out += [{"item_id": i} | span for i in self.items[number].ids]
        for number, supposed in starts.items():
            item = self.items[number]
            k, size = item.budget, len(item.text)
            low = high = None
            for start in [*sorted(supposed), None]:
                if low is not None and (start is None or start > high + size + 2 * k):
                    first = max(0, low - k)
                    window = clean[first : high + size + k]
                    for a, b, distance in occurrences(item.text, k, window):
                        back = origins(text) if back is None else back
                        span = {"start": back[first + a], "end": back[first + b - 1] + 1, "distance": distance}
                        out += [{"item_id": i} | span for i in item.ids]
                    low = None
                if start is not None:
                    low, high = start if low is None else low, start
        return sorted(out, key=lambda m: (m["start"], m["item_id"]))


def blocks(items: DataFrame, key: str, text: str) -> Iterator[list[Item]]:
    """Items that can be searched, in blocks of BLOCK_CHARS; equal texts are one item with several ids."""
    block: dict[str, Item] = {}
    size = 0
    rows = items.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    for row in rows.toLocalIterator():
        clean = folded(row["text"])
        if not clean:
            continue
        if clean in block:
            block[clean].ids.append(row["key"])
            continue
        block[clean] = Item(clean, [row["key"]])
        size += len(clean)
        if size >= BLOCK_CHARS:
            yield list(block.values())
            block, size = {}, 0
    if block:
        yield list(block.values())


def matched(documents: DataFrame, items: DataFrame, text: str, keep: list[str],
            item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """`keep` columns and `matches`: every occurrence of an item in the text."""
    out = documents.select(*keep, F.col(text).cast("string").alias("__text"),
                           F.array().cast(MATCHES).alias("matches"))
    schema = out.schema
    for block in blocks(items, item_key, item_text):
        shared = documents.sparkSession.sparkContext.broadcast(block)

        def search(batches, shared=shared):
            matcher = Matcher(shared.value)
            for batch in batches:
                found = [matcher.matches(t.as_py() or "") for t in batch["__text"]]
                before = batch["matches"]
                rows = [found[i] + before[i].as_py() if len(before[i]) else found[i] for i in range(len(found))]
                at = batch.schema.get_field_index("matches")
                yield batch.set_column(at, batch.schema.field(at), pa.array(rows, before.type))

        out = out.mapInArrow(search, schema)
    return out.drop("__text")
