"""N-gram Jaccard join by blocked sparse matrix products.

A document is a row of a sparse incidence matrix whose columns are its distinct n-grams of words. Two documents link
when 100 * |intersection| >= percent * |union|. The product of the matrix with its own transpose holds all
intersections; it is computed in blocks, and only where sizes leave a link possible:

1. Documents with equal sets are one class; from here on a row is a class, whatever the number of its copies.
2. Columns are put in one order for all rows: rare n-grams first, by a counting sketch of fixed size over all
   documents. Any fixed order is right; this one keeps frequent n-grams out of the way.
3. For a row of n columns, a partner shares one of the first n - ceil(n * percent / 100) + 1. These prefix entries
   are dealt by column into blocks of the matrix. Columns of a single class drop out.
4. Groups come first, links after them: a link never leaves its group. In each block, the entries of a column are put in
   order of size and cut where sizes no longer allow a link, and those of a stretch are paired with one class only
   (a star; its centre is the class whose name hashes lowest, so one class is the centre of a dense group in all
   columns that it has). The overlap counts of these pairs are added up over all blocks, and pairs below their bound
   go, unless the centre has DENSE classes or more. Each class is compared with the STARS partners of its largest
   counts and with the classes that meet it at these partners; links join classes to groups.
5. What is left: pairs between groups that were not compared, whose sizes and positions leave enough common columns and
   whose prefixes share as many as a linked pair must, so no link is lost. Pairs that share a column of up to SHORT
   classes are counted in its block, and a pair moves once for each block; the entries of a longer column move, and are
   paired where its classes lie in different groups.
6. Comparing: pairs are dealt into blocks by their left row. The block's members are a sparse matrix, which is
   multiplied by the left row (and, for stars, by its own transpose); pairs below the size-derived bound
   ceil(percent * (n + m) / (100 + percent)) go. Groups joined by the links found are the components: each is held
   together by links, and no link leaves it.
7. The join: each group is multiplied by its own transpose, which gives all links in it with their overlaps. A group
   of more than TILE classes is cut by size and class into parts; two parts meet in one tile where sizes allow a link,
   so a tile is bounded whatever the group. A tile gives a row for each class, with its links in arrays.

A column held by very many documents, as the sketch counts them, is dealt to several blocks and starred in each;
the stars' centres are starred in turn.

Defined results: null and empty texts have the empty set, size 0, and link with nothing; texts with fewer than k
words have their whole word sequence as the one n-gram; repeated rows are one class and share a component; a null
key is never the least key of a component that has another; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.arrow import U64, Words, chunks, grams, mix, pack, pack_sorted, unpack, unpack_sorted, views
from pulsegrid.llm.components import stars, with_centres
from pulsegrid.llm.storage import stored

K, PERCENT = 5, 75
#: Counters of the sketch (4 bytes each); it is broadcast.
SKETCH = 1 << 20
SLICE = 1 << 16
#: Bytes of text whose prefix entries make one block, and entries that a task packs at a time.
BLOCK_BYTES, PACKED = 40 << 20, 1 << 20
#: Classes that a task remembers, to send copies once.
SEEN = 1 << 18
#: A column counted more often is dealt to several blocks, each with about this many entries of it.
SPLIT = 1 << 16
#: Star centres that each class is compared with first.
STARS = 2
#: Classes around a centre that make a dense group: all of them are compared in blocks.
DENSE = 32
#: Classes of a column that is paired in its block; each of its entries makes (SHORT - 1) / 2 pairs at most.
SHORT = 4
#: Rows of a block: pairs of a class and its star's centre, pairs that share short columns, entries of longer columns.
STAR, PAIR, ENTRY = 0, 1, 2
HELD = ("kind int, column long, class long, n long, place long, centre long, centre_n long, shared long, reach boolean, "
        "often boolean")
#: Pairs compared in one block; classes are marked as wanted in a bitmap of 2**24 bits.
PAIRS, BITS, PAGE = 512, 1 << 24, 1 << 15
#: Classes in a part of a group; two parts at most are multiplied in one tile.
TILE = 512


@dataclass(frozen=True)
class Join:
    """Links hold between classes: documents of one class have equal sets, and all of them link with each other and
    with the documents of the linked classes."""

    documents: DataFrame  # key, n_shingles, class (null for empty sets), component_id
    links: DataFrame  # a, b (classes, each pair once), a_n, b_n, shared
    link_counts: DataFrame  # class, n_documents, n_links: other documents that each document of the class links with


def sets(texts: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of the texts that have words, cuts and n-gram hashes, a chunk of texts at a time: `found[cuts[i] : cuts[i +
    1]]` are the sorted distinct hashes of text `rows[i]`."""
    data, offsets = views(texts)
    for first, last in chunks(offsets):
        words = Words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        hashes = words.hashes(lower=True)
        rows = np.flatnonzero(np.diff(words.of))
        if not len(rows):
            continue
        starts, ends = words.of[rows], words.of[rows + 1]
        short = np.flatnonzero(ends - starts < k)
        found = np.zeros(len(hashes), U64)
        found[: max(0, len(hashes) - k + 1)] = grams(hashes, k)
        for a, b in zip(starts[short].tolist(), ends[short].tolist(), strict=True):
            found[a] = grams(hashes[a:b], b - a)[0]
        # No n-gram starts in the last words of a text: those places hold n-grams that reach into the next.
        ends = np.maximum(ends - k, starts) + 1
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            found[a:b].sort()
        new = np.append(True, found[1:] != found[:-1])
        new[starts] = True
        inside = np.zeros(len(found) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        new &= np.cumsum(inside[:-1], dtype=np.int8) > 0
        yield first + rows, np.append(0, np.cumsum(new))[np.append(starts, len(new))], found[new]


def class_names(found: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, as a signed number."""
    starts, sizes = cuts[:-1], np.diff(cuts).astype(U64)
    sums = np.add.reduceat(mix(found), starts)
    bits = np.bitwise_xor.reduceat(mix(found ^ U64(0xA5A5A5A5)), starts)
    return mix(sums * U64(0x9E3779B97F4A7C15) ^ mix(bits) ^ sizes).view(np.int64)


def _slots(found: np.ndarray) -> np.ndarray:
    """Counters of columns in the sketch."""
    return (found % U64(SKETCH)).astype(np.int64)


def least_overlap(n, m, percent: int):
    """Fewest common columns of a linked pair of sizes n and m."""
    return -(-(percent * (n + m)) // (100 + percent))


def _text(documents: DataFrame, text: str) -> DataFrame:
    return documents.select(F.col(text).cast("string").alias("text"))


def _profiled(batches, k: int) -> Iterator[pa.RecordBatch]:
    """key, by, n, class of each document; at the end the slices of the sketch."""
    sketch = np.zeros(SKETCH, np.int64)
    for batch in batches:
        n = np.zeros(batch.num_rows, np.int64)
        names = np.zeros(batch.num_rows, np.int64)
        for rows, cuts, found in sets(batch["text"], k):
            n[rows], names[rows] = np.diff(cuts), class_names(found, cuts)
            np.add.at(sketch, _slots(found), 1)
        empty = pa.nulls(batch.num_rows, pa.int64()), pa.nulls(batch.num_rows, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch["key"], batch["by"], pa.array(n), pa.array(names, mask=n == 0), *empty],
            names=["key", "by", "n", "class", "slice", "counts"])
    parts = sketch.reshape(-1, SLICE)
    some = np.flatnonzero(parts.any(1))
    yield pa.RecordBatch.from_arrays(
        [*(pa.nulls(len(some), pa.int64()) for _ in range(4)), pa.array(some, pa.int64()),
         pa.array([pack(parts[i].view(U64)) for i in some], pa.binary())],
        names=["key", "by", "n", "class", "slice", "counts"])


def _profiles(documents: DataFrame, key: str, text: str, k: int, by: str | None) -> DataFrame:
    """key, by, n, class of each document (class null for empty sets); besides, rows with slices of the sketch."""
    rows = documents.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"),
                            (F.col(by) if by else F.lit(None)).cast("long").alias("by"))
    return stored(rows.mapInArrow(lambda batches: _profiled(batches, k),
                                  "key long, by long, n long, class long, slice long, counts binary"), "profiles")


def _sketch(profiles: DataFrame) -> np.ndarray:
    """Counts of all documents' columns, as many numbers whatever the input."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(unpack(x.as_py()).view(np.int64) for x in table["counts"])
        return pa.table({"slice": table["slice"][:1], "counts": pa.array([pack(total.view(U64))], pa.binary())})

    slices = profiles.where("slice is not null").select("slice", "counts").groupBy("slice").applyInArrow(
        add, "slice long, counts binary")
    out = np.zeros(SKETCH, np.int64)
    for row in slices.collect():
        out[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = unpack(row["counts"]).view(np.int64)
    return np.minimum(out, np.iinfo(np.uint32).max).astype(np.uint32)


def prefix(found: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The first columns of a row in the common order; a linked row shares one of them. `found` is sorted."""
    n = len(found)
    order = np.argsort(counts, kind="stable")
    return found[order[: n - math.ceil(n * percent / 100) + 1]]


def _dealt(batches, k: int, percent: int, sketch: np.ndarray, blocks: int, split: int):
    """Prefix entries by block, packed."""
    columns, rows, places, names, sizes, held = [], [], [], [], [], 0

    def flush():
        column, row, place = (np.concatenate(x) for x in (columns, rows, places))
        name, size = np.array(names, np.int64), np.array(sizes, np.int64)
        often = sketch[_slots(column)].astype(np.int64) // split
        share = np.where(often > 0, (name[row].view(U64) % (often + 1).astype(U64)), U64(0))
        block = (((column >> U64(32)) * U64(blocks)) >> U64(32)) + share * U64(0x9E3779B1)
        block = np.where(often > 0, block % U64(max(blocks, 1)) + U64(blocks), block)
        order = np.lexsort((column, block))
        column, row, place, block, often = column[order], row[order], place[order], block[order], often[order]
        numbers, starts = np.unique(block, return_index=True)
        cuts = np.append(starts, len(block))
        made = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            used, local = np.unique(row[a:b], return_inverse=True)
            made.append((pack_sorted(column[a:b]), pack(local), pack(place[a:b]), pack(name[used].view(U64)),
                         pack(size[used]), bool(often[a] > 0)))
        for x in (columns, rows, places, names, sizes):
            x.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers.astype(np.int64)), *(pa.array(c, pa.binary()) for c in list(zip(*made, strict=True))[:5]),
             pa.array([m[5] for m in made], pa.bool_())],
            names=["block", "columns", "local", "places", "classes", "sizes", "often"])

    seen = set()
    for batch in batches:
        if len(seen) > SEEN:
            seen.clear()
        for _, cuts, found in sets(batch["text"], k):
            counts = sketch[_slots(found)]
            for i, name in enumerate(class_names(found, cuts).tolist()):
                if name in seen:
                    continue
                seen.add(name)
                own = slice(cuts[i], cuts[i + 1])
                first = prefix(found[own], counts[own], percent)
                columns.append(first)
                rows.append(np.full(len(first), len(names)))
                places.append(np.arange(len(first)))
                names.append(name)
                sizes.append(own.stop - own.start)
                held += len(first)
                if held >= PACKED:
                    yield flush()
                    held = 0
    if held:
        yield flush()


def _centres(starts: np.ndarray, size: np.ndarray, name: np.ndarray, percent: int) -> np.ndarray:
    """For each entry, in order of column and size, the place of its stretch's centre. Sizes in a stretch may link."""
    ends = np.append(starts[1:], len(size))
    wide = np.flatnonzero(100 * size[starts] < percent * size[ends - 1])
    more = []
    for start, end in zip(starts[wide].tolist(), ends[wide].tolist(), strict=True):
        own = size[start:end]
        at = 0
        while (at := int(np.searchsorted(own, 100 * own[at] // percent, side="right"))) < len(own):
            more.append(start + at)
    starts = np.sort(np.append(starts, np.array(more, np.int64)))
    lengths = np.diff(np.append(starts, len(size)))
    stretch = np.repeat(np.arange(len(starts)), lengths)
    lowest = np.lexsort((mix(name.view(U64)), stretch))[starts]
    return np.repeat(lowest, lengths)


def _counted(a: np.ndarray, b: np.ndarray, a_n: np.ndarray, b_n: np.ndarray, reach: np.ndarray) -> list[np.ndarray]:
    """Each pair (a, b) once: a, its size, b, its size, how often it came, and whether it came with `reach`."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)])
    reached = np.logical_or.reduceat(reach[order], first) if len(first) else reach
    return [a[first], a_n[order][first], b[first], b_n[order][first], np.diff(np.append(first, len(a))), reached]


def _short_pairs(column: np.ndarray, name: np.ndarray, size: np.ndarray, place: np.ndarray, percent: int):
    """Pairs of classes whose sizes allow a link, for each of the columns that they share. `reach`: from a column on,
    both rows have as many columns left as a link needs. Entries come in order of column and size."""
    found = []
    for by in range(1, SHORT):
        a = np.flatnonzero((column[by:] == column[:-by]) & (100 * size[:-by] >= percent * size[by:]))
        b = a + by
        reach = np.minimum(size[a] - place[a], size[b] - place[b]) >= least_overlap(size[a], size[b], percent)
        swap = name[a] > name[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        found.append((name[a], name[b], size[a], size[b], reach))
    return _counted(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _starred(table: pa.Table, percent: int) -> pa.Table:
    """Of the block's columns that more than one class holds: STAR rows, a class and the centre of its star with the number
    of columns; PAIR rows, two classes and the number of short columns; ENTRY rows of the other columns."""
    parts = []
    for r in table.to_pylist():
        local = unpack(r["local"]).astype(np.int64)
        parts.append((unpack_sorted(r["columns"]), unpack(r["classes"])[local].view(np.int64),
                      unpack(r["sizes"]).astype(np.int64)[local], unpack(r["places"]).astype(np.int64)))
    column, name, size, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    often = table["often"][0].as_py()
    order = np.lexsort((name, size, column))
    column, name, size, place = column[order], name[order], size[order], place[order]
    once = np.append(True, (column[1:] != column[:-1]) | (name[1:] != name[:-1]))
    column, name, size, place = column[once], name[once], size[once], place[once]
    starts = np.flatnonzero(np.append(True, column[1:] != column[:-1]))
    lengths = np.diff(np.append(starts, len(column)))
    first = _centres(starts, size, name, percent)
    centre, centre_n, length = name[first], size[first], np.repeat(lengths, lengths)
    spoke = name != centre
    stars = _counted(name[spoke], centre[spoke], size[spoke], centre_n[spoke], np.zeros(int(spoke.sum()), bool))
    # A column that is dealt to several blocks is paired in none of them.
    short = (length > 1) & (length <= SHORT) & (not often)
    pairs = _short_pairs(column[short], name[short], size[short], place[short], percent)
    held = (length > SHORT) | often
    n = int(held.sum())
    nothing = lambda rows: pa.nulls(len(rows[0]), pa.int64())

    def counted(kind: int, rows: list[np.ndarray]) -> pa.Table:
        a, a_n, b, b_n, shared, reach = rows
        return pa.table([pa.array(np.full(len(a), kind, np.int32)), nothing(rows), pa.array(a), pa.array(a_n), nothing(rows),
                         pa.array(b), pa.array(b_n), pa.array(shared), pa.array(reach),
                         pa.array(np.zeros(len(a), bool))], names=names)

    names = [x.split()[0] for x in HELD.split(", ")]
    entries = pa.table([pa.array(np.full(n, ENTRY, np.int32)),
                        *(pa.array(x[held]) for x in (column.view(np.int64), name, size, place, centre, centre_n)),
                        pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), pa.array(np.full(n, often))], names=names)
    return pa.concat_tables([counted(STAR, stars), counted(PAIR, pairs), entries]).combine_chunks()


def _wanted(pairs: DataFrame) -> np.ndarray:
    """Bitmap of the classes in pairs, 2 MB whatever their number; others may be marked as well."""
    slot = F.pmod("class", F.lit(BITS)) + 1
    pages = (
        pairs.select(F.explode(F.array("a", "b")).alias("class")).select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("page"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    )
    bits = np.zeros(BITS, bool)
    for row in pages:
        at = (row["page"] - 1) * PAGE
        bits[at : at + PAGE] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")[:PAGE]
    return np.packbits(bits)


def _overlaps(row: np.ndarray, cells: np.ndarray, cuts: np.ndarray, width: int) -> np.ndarray:
    """Common columns of a row with each row of a sparse matrix."""
    vector = np.zeros(width, np.int64)
    vector[row] = 1
    return np.add.reduceat(vector[cells], cuts)


def _multiplied(table: pa.Table, percent: int, among: bool) -> pa.Table:
    """Linked pairs of a block: each left row times the sparse matrix of its members. With `among`, members are
    compared with each other as well, and a link of each to one before it tells which belong together."""
    rows: dict[int, np.ndarray] = {}
    members_of: dict[int, set[int]] = {}
    for r in table.to_pylist():
        if r["class"] not in rows:
            rows[r["class"]] = unpack_sorted(r["columns"])
        if r["b"] is not None:
            members_of.setdefault(r["a"], set()).add(r["b"])
    out = []
    for a, found in members_of.items():
        names = [x for x in (a, *sorted(found)) if x in rows]
        sizes = np.array([len(rows[x]) for x in names])
        columns, cells = np.unique(np.concatenate([rows[x] for x in names]), return_inverse=True)
        starts = np.append(0, np.cumsum(sizes))
        root = list(range(len(names)))
        for i in range(len(names) - 1 if among else min(1, len(names) - 1)):
            rest = slice(i + 1, len(names))
            overlap = _overlaps(cells[starts[i] : starts[i + 1]], cells[starts[i + 1] :],
                                starts[i + 1 : -1] - starts[i + 1], len(columns))
            for j in (np.flatnonzero(overlap >= least_overlap(sizes[i], sizes[rest], percent)) + i + 1).tolist():
                x, y = i, j
                while root[x] != x:
                    root[x] = x = root[root[x]]
                while root[y] != y:
                    root[y] = y = root[root[y]]
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((names[i], names[j]))
    return pa.table([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _sets_of(documents: DataFrame, pairs: DataFrame, text: str, k: int) -> DataFrame:
    """class, columns (packed) of the classes in pairs; others may come as well, and a class several times."""
    wanted = documents.sparkSession.sparkContext.broadcast(_wanted(pairs))

    def wanted_sets(batches):
        bits = wanted.value
        seen = set()
        for batch in batches:
            if len(seen) > SEEN:
                seen.clear()
            names, blobs = [], []
            for _, cuts, found in sets(batch["text"], k):
                name = class_names(found, cuts)
                slot = name % BITS
                marked = np.flatnonzero(bits[slot >> 3] >> (7 - (slot & 7)) & 1)
                for i, one in zip(marked.tolist(), name[marked].tolist(), strict=True):
                    if one not in seen:
                        seen.add(one)
                        names.append(one)
                        blobs.append(pack_sorted(found[cuts[i] : cuts[i + 1]]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blobs, pa.binary())],
                                             names=["class", "columns"])

    return _text(documents, text).mapInArrow(wanted_sets, "class long, columns binary")


def linked(documents: DataFrame, pairs: DataFrame, text: str, k: int, percent: int, among: bool = False) -> DataFrame:
    """Links that join what the stored pairs (a, b) of classes join; with `among`, also what links between the partners
    of a class join, as far as they meet in a block."""
    total = pairs.count()
    if not total:
        return pairs
    blocks = total // PAIRS + 1
    # A left row with many partners is split by partner; rows with few go to one block.
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS).cast("long").alias("shares"))
    block = F.pmod(F.xxhash64("a", F.pmod("b", "shares")), F.lit(blocks))
    dealt = pairs.join(many, "a").select("a", "b", block.alias("block"))
    roles = dealt.select("block", "a", "b", F.explode(F.array("a", "b")).alias("class"))
    roles = roles.withColumn("b", F.when(F.col("class") == F.col("b"), F.col("b"))).distinct()
    return stored(
        _sets_of(documents, pairs, text, k).join(roles, "class").groupBy("block").applyInArrow(
            lambda t: _multiplied(t, percent, among), "a long, b long"),
        "linked")


def _least_shared(n: Column, m: Column, percent: int) -> Column:
    """Fewest prefix columns that a linked pair shares. Of n columns at most n - need are not common; those may all
    come before the common ones, the rest of the prefix is common."""
    need = F.ceil(percent * (n + m) / (100 + percent))
    spare = lambda size: need - F.ceil(size * percent / 100) + 1
    return F.least(spare(n), spare(m))


def _partners(held: DataFrame, percent: int) -> DataFrame:
    """Pairs (centre, class): for each class the centres with which it shares most prefix columns."""
    counted = held.where(F.col("kind") == STAR).groupBy("class", "centre").agg(
        F.sum("shared").alias("shared"),
        F.max(_least_shared(F.col("n"), F.col("centre_n"), percent)).alias("least"))
    # A class has no more centres than prefix columns.
    ranked = F.sort_array(F.collect_list(F.struct("shared", "centre")), asc=False)
    spokes = counted.groupBy("centre").agg(F.count("*").alias("spokes"))
    near = counted.join(spokes, "centre").where((F.col("shared") >= F.col("least")) | (F.col("spokes") >= DENSE))
    best = near.groupBy("class").agg(F.slice(ranked, 1, STARS).alias("best")).select(
        F.explode("best.centre").alias("a"), F.col("class").alias("b"))
    centres = held.where((F.col("kind") == ENTRY) & F.col("often")).select("column", "centre").distinct()
    first = centres.groupBy("column").agg(F.min("centre").alias("first"))
    between = centres.join(first, "column").where("centre <> first").select(
        F.col("first").alias("a"), F.col("centre").alias("b"))
    return best.union(between)


def _left_over(held: DataFrame, known: DataFrame, compared: DataFrame, percent: int) -> DataFrame:
    """Pairs between components that sizes, positions and prefixes allow, without the pairs compared before."""
    entries = held.where(F.col("kind") == ENTRY).select("column", "class", "n", "place")
    component = lambda rows, name, group: rows.join(
        known.select(F.col("node").alias(name), F.col("component").alias(group)), name, "left"
    ).withColumn(group, F.coalesce(group, name))
    rows = component(entries, "class", "component")
    mixed = rows.groupBy("column").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rows = rows.join(mixed.where("low <> high").select("column"), "column")
    a, b = rows.alias("a"), rows.alias("b")
    need = F.ceil(percent * (F.col("a.n") + F.col("b.n")) / (100 + percent))
    far = a.join(
        b,
        (F.col("a.column") == F.col("b.column")) & (F.col("a.class") < F.col("b.class"))
        & (F.col("a.component") != F.col("b.component"))
        & (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
        & (F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place")) >= need),
    ).select(F.col("a.class").alias("a"), F.col("b.class").alias("b"), F.col("a.n").alias("a_n"),
             F.col("b.n").alias("b_n"), F.lit(0).cast("long").alias("shared"), F.lit(True).alias("reach")).distinct()
    near = held.where(F.col("kind") == PAIR).select(
        F.col("class").alias("a"), F.col("centre").alias("b"), F.col("n").alias("a_n"), F.col("centre_n").alias("b_n"),
        "shared", "reach")
    # The first column that two linked classes share has `reach`, whether it is short or not.
    pairs = near.union(far).groupBy("a", "b").agg(
        F.max("a_n").alias("a_n"), F.max("b_n").alias("b_n"), F.sum("shared").alias("shared"),
        F.bool_or("reach").alias("reach")).where("reach").drop("reach")
    # Columns that two classes share are held by two: all of them are counted, or are among the entries.
    longer = entries.groupBy("class").agg(F.collect_set("column").alias("columns"))
    side = lambda name: longer.select(F.col("class").alias(name), F.col("columns").alias(f"{name}_columns"))
    least = _least_shared(F.col("a_n"), F.col("b_n"), percent)
    size = lambda columns: F.coalesce(F.when(columns.isNotNull(), F.size(columns)), F.lit(0))
    pairs = pairs.join(side("a"), "a", "left").where(F.col("shared") + size(F.col("a_columns")) >= least)
    pairs = pairs.join(side("b"), "b", "left").where(
        F.col("shared") + size(F.array_intersect("a_columns", "b_columns")) >= least).select("a", "b")
    done = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = component(component(pairs, "a", "a_in"), "b", "b_in").where("a_in <> b_in").select("a", "b")
    return pairs.join(done, ["a", "b"], "left_anti")


def _tiles(members: DataFrame, percent: int, tile: int) -> DataFrame:
    """block, component, left, right, part, class, copies: a row for each tile that a class takes part in. Groups of
    up to `tile` classes are one tile, and share blocks. In larger ones a part holds sizes of one range, so wide that
    linked sizes lie in the same range or in neighbouring ones."""
    width = max(math.log(100 / percent), 0.01) * (1 + 1e-9)
    sized = members.withColumn("range", F.floor(F.log("n") / width))
    counted = sized.groupBy("component", "range").agg(F.count("*").alias("classes"))
    entry = F.struct("range", F.ceil(F.col("classes") / tile).alias("parts"))
    large = counted.groupBy("component").agg(
        F.sum("classes").alias("classes"), F.map_from_entries(F.collect_list(entry)).alias("parts"),
    ).where(F.col("classes") > tile).drop("classes")
    number = lambda size, place: size * F.lit(1 << 24) + place
    parts = lambda size: F.coalesce(F.try_element_at("parts", size), F.lit(0).cast("long"))
    own = number(F.col("range"), F.pmod(F.xxhash64("class"), parts(F.col("range"))))
    others = F.flatten(F.transform(
        F.array(*(F.col("range") + i for i in (-1, 0, 1))),
        lambda size: F.when(parts(size) > 0, F.transform(
            F.sequence(F.lit(0).cast("long"), parts(size) - 1), lambda place: number(size, place),
        )).otherwise(F.array().cast("array<bigint>"))))
    # One group for each `tile` classes at most is large. Stored, the table has a size that the join goes by: a small one
    # is broadcast, a larger one is met by a shuffle, in which rows of a large group may be split.
    dealt = sized.join(stored(large, "large-groups"), "component", "left")
    none = F.lit(0).cast("long")
    dealt = dealt.select(
        "component", "class", "copies", F.col("parts").isNotNull().alias("large"),
        F.when(F.col("parts").isNull(), none).otherwise(own).alias("part"),
        F.explode(F.when(F.col("parts").isNull(), F.array(none)).otherwise(others)).alias("other"))
    blocks = members.count() // tile + 1
    return dealt.select(
        F.when(F.col("large"), F.xxhash64("component", F.least("part", "other"), F.greatest("part", "other")))
        .otherwise(F.pmod(F.xxhash64("component"), F.lit(blocks))).alias("block"),
        "component", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"), "part",
        "class", "copies")


def _tile_links(rows: dict[int, tuple[np.ndarray, int, int]], left: int, right: int, percent: int) -> Iterator[tuple]:
    """Of a tile's classes, with columns, copies and part: class, size, the linked classes behind it, their sizes and
    overlaps, and the documents that it links with."""
    names = sorted(rows, key=lambda x: (rows[x][2], x))
    sizes = np.array([len(rows[x][0]) for x in names])
    copies = np.array([rows[x][1] for x in names])
    first = sum(rows[x][2] == left for x in names)
    columns, cells = np.unique(np.concatenate([rows[x][0] for x in names]), return_inverse=True)
    starts = np.append(0, np.cumsum(sizes))
    met = np.zeros(len(names), np.int64)
    found = []
    for i in range(len(names)):
        begin = i + 1 if left == right else max(i + 1, first)
        hits = np.zeros(0, np.int64)
        overlap = hits
        if i < first and begin < len(names):
            overlap = _overlaps(cells[starts[i] : starts[i + 1]], cells[starts[begin] :],
                                starts[begin:-1] - starts[begin], len(columns))
            hits = np.flatnonzero(overlap >= least_overlap(sizes[i], sizes[begin:], percent))
            overlap, hits = overlap[hits], hits + begin
        met[i] += copies[hits].sum()
        met[hits] += copies[i]
        found.append((hits, overlap))
    ids = np.array(names, np.int64)
    for i, (hits, overlap) in enumerate(found):
        if met[i]:
            yield names[i], sizes[i], ids[hits], sizes[hits], overlap, met[i]


LINKS = "class long, n long, b array<long>, b_n array<long>, shared array<long>, met long"


def _all_links(documents: DataFrame, members: DataFrame, text: str, k: int, percent: int, tile: int) -> DataFrame:
    """All links between the classes of each group, a row for each class and tile (LINKS)."""

    def multiply(table: pa.Table) -> pa.Table:
        tiles: dict[tuple, dict] = {}
        blobs: dict[int, np.ndarray] = {}
        for r in table.to_pylist():
            if r["class"] not in blobs:
                blobs[r["class"]] = unpack_sorted(r["columns"])
            tiles.setdefault((r["component"], r["left"], r["right"]), {})[r["class"]] = (
                blobs[r["class"]], r["copies"], r["part"])
        out = [x for (_, left, right), rows in tiles.items() for x in _tile_links(rows, left, right, percent)]
        names = ["class", "n", "b", "b_n", "shared", "met"]
        kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.int64()]
        return pa.table([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=names)

    pairs = members.select(F.col("class").alias("a"), F.col("class").alias("b"))
    return stored(
        _sets_of(documents, pairs, text, k).join(_tiles(members, percent, tile), "class")
        .groupBy("block").applyInArrow(multiply, LINKS),
        "joined")


def _grouped(documents: DataFrame, key: str, text: str, k: int, percent: int, block_bytes: int,
             split: int, by: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Profiles of the documents; class, least (key), first (by `by`, nulls last, and key), n, copies of each class; node,
    component of the classes that have links, without those that give a component its name."""
    spark = documents.sparkSession
    profiles = _profiles(documents, key, text, k, by)
    total = documents.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    blocks = int(total // block_bytes + 1)
    sketch = spark.sparkContext.broadcast(_sketch(profiles))

    def deal(batches):
        return _dealt(batches, k, percent, sketch.value, blocks, split)

    schema = "block long, columns binary, local binary, places binary, classes binary, sizes binary, often boolean"
    held = stored(
        _text(documents, text).mapInArrow(deal, schema).groupBy("block").applyInArrow(
            lambda table: _starred(table, percent), HELD),
        "held")
    compared = stored(_partners(held, percent).distinct(), "pairs")
    links = linked(documents, compared, text, k, percent, among=True)
    known = stars(links)
    more = linked(documents, stored(_left_over(held, known, compared, percent), "pairs"), text, k, percent)
    if more.take(1):
        # What is known already, as stars: it takes fewer rounds than the links that it was made of.
        known = stars(known.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    rows = profiles.where("slice is null")
    classes = rows.where("class is not null").groupBy("class").agg(
        F.min("key").alias("least"), F.min(F.struct(F.col("by").isNull().alias("none"), "by", "key")).alias("first"),
        F.max("n").alias("n"), F.count("*").alias("copies"))
    return rows.select("key", "n", "class"), classes, known


def _in_components(classes: DataFrame, known: DataFrame) -> DataFrame:
    """Classes with their component."""
    return classes.join(known.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))


def _named(rows: DataFrame, classes: DataFrame, known: DataFrame) -> DataFrame:
    """key, n_shingles, class, component_id of each document."""
    classes = _in_components(classes, known)
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "component").select("class", "component_id")
    return rows.join(named, "class", "left").select(
        "key", F.col("n").alias("n_shingles"), "class",
        F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"))


def jaccard_join(documents: DataFrame, key: str, text: str, k: int = K, percent: int = PERCENT,
                 block_bytes: int = BLOCK_BYTES, split: int = SPLIT, tile: int = TILE) -> Join:
    """All links, and the components that they make."""
    rows, classes, known = _grouped(documents, key, text, k, percent, block_bytes, split)
    members = stored(
        classes.drop("first").join(with_centres(known).withColumnRenamed("node", "class"), "class"), "members")
    links = _all_links(documents, members, text, k, percent, tile)
    each = links.select("class", "n", F.explode(F.arrays_zip("b", "b_n", "shared")).alias("link"))
    met = links.groupBy("class").agg(F.sum("met").alias("met"))
    return Join(
        _named(rows, classes, known),
        each.select(F.col("class").alias("a"), "link.b", F.col("n").alias("a_n"), "link.b_n", "link.shared"),
        classes.join(met, "class", "left").select(
            "class", F.col("copies").alias("n_documents"),
            (F.col("copies") - 1 + F.coalesce("met", F.lit(0))).alias("n_links")))


def jaccard_components(documents: DataFrame, key: str, text: str, k: int = K, percent: int = PERCENT,
                       block_bytes: int = BLOCK_BYTES, split: int = SPLIT) -> DataFrame:
    """key, n_shingles, component_id (least key reachable by links) of each document."""
    return _named(*_grouped(documents, key, text, k, percent, block_bytes, split)).select(
        "key", "n_shingles", "component_id")


def jaccard_first(documents: DataFrame, key: str, text: str, by: str, k: int = K, percent: int = PERCENT,
                  block_bytes: int = BLOCK_BYTES, split: int = SPLIT) -> DataFrame:
    """key of one document of each component, that with the least `by` (a number; nulls come last), then the least key.
    Documents with an empty set are in no component. Classes are joined, not documents, and `by` comes along with the
    sets: a shuffle less for each column that would be looked up."""
    _, classes, known = _grouped(documents, key, text, k, percent, block_bytes, split, by)
    first = _in_components(classes.select("class", "first"), known).groupBy("component").agg(F.min("first").alias("first"))
    return stored(first.select(F.col("first.key").alias("key")), "first")
