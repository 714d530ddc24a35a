"""Secret scans with corpus-wide ownership of candidate values. DataFrame functions only.

Candidates of three kinds are found in every whole text, leftmost and without overlap in each kind: `assign` (a
value given to a password-like name), `access` (an access key id) and `hex` (a run of lower-case hexadecimal
digits). Beside them, bare `word` candidates are taken: long runs of key characters that mix letters with digits,
without the punctuation of the sentence or path around them.

The value of each candidate, without punctuation at its ends, is hashed, and the hashes of base candidates are
counted over the corpus: distinct owners and distinct repositories that hold it. A value of WIDELY owners in as many
repositories is a widely copied example; a live-looking value (letters and digits mixed, many different
characters) of fewer is somebody's credential. A bare occurrence says nothing about who owns a value and isn't counted.
The verdict adds spans: a bare word whose value was given to a password-like name somewhere in the corpus, and is
live-looking and no example, is reported as `owned` where no base span overlaps it.

Positions are code points, ends exclusive. They come from the lengths of matches and of the gaps between them, as
regular-expression functions return strings only.

Defined results: null texts have no spans; null owners and repositories count as one unnamed owner and repository;
rows that repeat a record have spans of their own but add no owner; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.storage import stored


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    group: int  # of the value
    least: int  # characters of the value
    guard: str = ""  # a cheaper pattern that every text with a match has


#: Kinds in the order in which spans that start together are listed. Runs that are too short for `access` and `hex`
#: match nothing, which is the same as dropping them, since both patterns take whole runs. A look back keeps the
#: search from trying a run again from each of its characters.
BASE = (
    Kind("assign",
         r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
         r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Kind("access", r"AKIA[A-Z0-9]{14,}", 0, 18, "AKIA"),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]{16,}", 0, 16),
)
#: Whole runs of key characters with a digit and a letter among them.
WORD_RUN = r"[A-Za-z0-9+/_.=-]{12,}"
WORD = Kind("word", r"(?<![A-Za-z0-9+/_.=-])(?=[A-Za-z+/_.=-]*[0-9])(?=[0-9+/_.=-]*[A-Za-z])" + WORD_RUN, 0, 12)
FOUND = "array<struct<start:int,end:int,value:string>>"
ADDED = "owned"
#: Different characters of a live-looking value.
LEAST_DISTINCT = 8
#: A value that base spans of this many owners hold, in this many repositories, is widely copied; with fewer, somebody's.
WIDELY = 5
#: Ends of a bare run that belong to the sentence or path around it.
ENDS = "+/_.=-"
OUTSIDE = rf"^[{ENDS}]+|(?<![{ENDS}])[{ENDS}]+$"
#: Shares of the rows that hold one value, each joined with the value's verdict by itself.
SHARES = 8
MASK = "[SECRET]"
#: Spans of a text that are handled as one array; texts with more are handled block by block.
BLOCK = 256


def live_looking(value: Column) -> Column:
    different = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (different >= LEAST_DISTINCT)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(items: Column) -> Column:
    """An array in blocks of BLOCK, so that what grows with each item is a block and not the whole; none for none."""
    return _bound(items, lambda a: F.when(F.size(a) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int")),
        lambda i: F.slice(a, i * BLOCK + 1, F.lit(BLOCK)))).otherwise(F.slice(F.array(a), 1, 0)))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda n, x: n + x)


def spans(text: Column, kind: Kind) -> Column:
    """array<struct<start, end, value>> of the matches whose value is long enough. A text without a match is read
    once, by the guard."""
    # Matches, their values and the gaps before them, side by side; behind the last match there is one more gap.
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    pieces = F.arrays_zip(whole.alias("match"), values.alias("value"), F.split(text, kind.pattern, -1).alias("gap"))

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["gap"])
        end = start + F.length(piece["match"])
        found = F.struct(start.alias("start"), end.alias("end"), piece["value"].alias("value"))
        kept = F.when(F.length(piece["value"]) >= kind.least, F.array(found)).otherwise(F.array().cast(FOUND))
        return F.struct(F.coalesce(end, start).alias("at"), F.concat(state["found"], kept).alias("found"))

    def place(block: Column, before: Column) -> Column:
        zero = F.struct(before.alias("at"), F.array().cast(FOUND).alias("found"))
        return F.aggregate(block, zero, step, lambda state: state["found"])

    length = lambda piece: F.length(piece["gap"]) + F.coalesce(F.length(piece["match"]), F.lit(0))
    lengths = lambda block: F.aggregate(block, F.lit(0), lambda n, piece: n + length(piece))
    found = _bound(_blocks(pieces), lambda blocks: _bound(F.transform(blocks, lengths), lambda sizes: F.flatten(
        F.transform(blocks, lambda block, i: place(block, _total(F.slice(sizes, 1, i)))))))
    return F.when(text.rlike(kind.guard or kind.pattern), found).otherwise(F.array().cast(FOUND))


def _hashed(found: Column, number: int) -> Column:
    name = lambda value: F.regexp_replace(value, OUTSIDE, "")
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"),
        F.sha2(name(s["value"]), 256).alias("hash"), live_looking(s["value"]).alias("live"),
    ))


def _trimmed(found: Column) -> Column:
    """Spans of bare runs without the punctuation at their ends."""
    def cut(s: Column) -> Column:
        value = F.regexp_replace(s["value"], OUTSIDE, "")
        start = s["start"] + F.length(s["value"]) - F.length(F.regexp_replace(s["value"], rf"^[{ENDS}]+", ""))
        return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"))

    return F.filter(F.transform(found, cut), lambda s: F.length(s["value"]) >= WORD.least)


def candidates(documents: DataFrame, text: str, owner: str, repository: str, keep: dict[str, str]) -> DataFrame:
    """A stored row for each record: its number, owner, repository, the kept columns under new names, `base` spans
    and bare `words`, with hashes in place of values."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = F.concat(*(_hashed(spans(content, k), i) for i, k in enumerate(BASE)))
    words = F.filter(_hashed(_trimmed(spans(content, WORD)), len(BASE)), lambda s: s["live"])
    found = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        *(F.col(c).alias(name) for c, name in keep.items()),
        F.array_sort(base).alias("base"), words.alias("words"),
    )
    return stored(found, "secrets")


def ownership(found: DataFrame) -> DataFrame:
    """hash, owners, repositories, assigned: the holders of each value in base spans. Summed before each shuffle, so a value that
    many rows hold arrives as a row for each task."""
    each = found.select("owner", "repository", F.explode("base").alias("s")).select(
        "owner", "repository", F.col("s.hash").alias("hash"), (F.col("s.kind") == 0).alias("assigned"))
    held = each.groupBy("hash", "owner", "repository").agg(F.max("assigned").alias("assigned"))
    owned = held.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.max("assigned").alias("assigned"))
    return owned.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"),
        F.max("assigned").alias("assigned"),
    )


def _apart(words: Column, base: Column) -> Column:
    """The words that no base span overlaps. Base spans are sorted by start, and only blocks that reach a word are
    looked into."""
    def reached(word: Column, span: Column) -> Column:
        return (span["start"] < word["end"]) & (word["start"] < span["end"])

    reach = lambda block: F.struct(
        F.get(block, F.lit(0))["start"].alias("start"), F.array_max(block["end"]).alias("end"), block.alias("spans"))
    blocks = F.transform(_blocks(base), reach)
    return _bound(blocks, lambda bs: F.filter(words, lambda w: ~F.exists(
        bs, lambda b: reached(w, b) & F.exists(b["spans"], lambda s: reached(w, s)))))


def judged(found: DataFrame) -> DataFrame:
    """row, owned (spans to add), n_live and n_example (base spans of somebody's and of widely copied values), for the
    rows that have any candidate."""
    verdicts = ownership(found).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    bare = F.when(F.size("words") > 0, _apart(F.col("words"), F.col("base"))).otherwise(F.col("words"))
    each = found.select("row", F.pmod("row", F.lit(SHARES)).cast("int").alias("share"),
                        F.explode(F.concat("base", bare)).alias("s"))
    each = each.select("row", "share", "s", F.col("s.hash").alias("hash")).join(verdicts, ["hash", "share"])
    example = (F.col("owners") >= WIDELY) & (F.col("repositories") >= WIDELY)
    word = F.col("s.kind") == len(BASE)
    added = word & F.col("assigned") & ~example
    span = F.struct("s.start", "s.kind", "s.end")
    return each.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(added, span))).alias("owned"),
        F.sum((~word & ~example & F.col("s.live")).cast("long")).alias("n_live"),
        F.sum((~word & example).cast("long")).alias("n_example"),
    )


def scan(documents: DataFrame, text: str, owner: str, repository: str, keep: dict[str, str]) -> DataFrame:
    """The kept columns, base and owned (arrays of start, kind, end), n_live, n_example."""
    found = candidates(documents, text, owner, repository, keep)
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"),
                                                  s["end"].alias("end")))
    return found.drop("words", "owner", "repository").join(judged(found), "row", "left").select(
        *keep.values(), base.alias("base"), F.coalesce("owned", empty).alias("owned"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"),
    )


def listed(found: Column) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    names = F.array(*(F.lit(k.name) for k in BASE), F.lit(ADDED))
    return F.array_join(F.transform(
        found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    ), ",")


def redacted(text: Column, found: Column) -> Column:
    """The text with MASK for every stretch that spans cover. Each block of spans masks its own part of the text."""
    def masked(block: Column, at: Column) -> Column:
        first = F.struct(at.alias("at"), F.lit("").alias("out"))

        def part(stretch: Column) -> Column:
            def step(state: Column, s: Column) -> Column:
                fresh = s["start"] >= state["at"]
                gap = F.substring(stretch, state["at"] - at + 1, s["start"] - state["at"])
                return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                                F.when(fresh, F.concat(state["out"], gap, F.lit(MASK))).otherwise(state["out"]).alias("out"))

            return F.aggregate(block, first, step, lambda state: state["out"])

        return _bound(F.substring(text, at + 1, F.array_max(block["end"]) - at), part)

    def joined(blocks: Column) -> Column:
        ends = F.transform(blocks, lambda b: F.array_max(b["end"]))
        reached = lambda ends, i: F.coalesce(F.array_max(F.slice(ends, 1, i)), F.lit(0))
        return _bound(ends, lambda e: F.concat(
            F.array_join(F.transform(blocks, lambda b, i: masked(b, reached(e, i))), ""),
            F.substring(text, F.array_max(e) + 1, F.length(text))))

    return F.when(F.size(found) > 0, _bound(_blocks(F.array_sort(found)), joined)).otherwise(text)
