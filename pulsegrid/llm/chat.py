"""Chat formatting of typed content parts, with a loss mask and a way back, in column expressions only.

A turn's content is a list of parts: text, image, audio or document. A `Visitor` flattens the list: text is escaped,
any other part becomes a placeholder that carries its number in the list, and is recorded as an attachment with its
reference and the number of tokens that the placeholder expands to. Two text parts side by side are kept apart by a
joint, so the list comes back as it was.

The template wraps role and body of each turn in control strings. Each control string starts with `<` or `[`, the
only such character in it. Where a text holds one, with any number of backslashes behind its first character,
one more backslash goes there; taking one away is the way back, and no text holds a control string after it.

Turns are formatted before they move. A running sum of lengths gives each turn its place in the conversation's text,
so the loss mask is found without reading that text again, and the way back cuts each turn by its own offsets: work is
linear in the text. A conversation is one row of the result and must fit in one (2 GB); none is cut short.

Defined results: turns are ordered by turn (null first), then role, then parts; repeated rows are turns of their own;
a null role, text or part is an empty one; parts of an unknown kind count as text; a null or empty list of parts is
an empty body; a null conversation id is a conversation; without rows there is no result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A content part. Fields that a kind has no use for are null.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


@dataclass(frozen=True)
class Template:
    begin: str = "<s>"
    named: str = "[INST]"  # behind the role
    end: str = "[/INST]</s>"
    joint: str = "<+>"
    trained: tuple[str, ...] = ("assistant",)
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<+>", "<unk>", "<pad>")

    def controls(self, visitor: Visitor) -> str:
        """What follows the first character of a control string, as a pattern."""
        fixed = [re.escape(c[1:]) for c in self.reserved]
        return "|".join([*fixed, f"(?:{'|'.join(visitor.kinds())}):[0-9]+>"])

    def escaped(self, text: Column, visitor: Visitor) -> Column:
        return F.regexp_replace(text, rf"([<\[])(\\*)({self.controls(visitor)})", r"$1\\$2$3")

    def unescaped(self, text: Column, visitor: Visitor) -> Column:
        return F.regexp_replace(text, rf"([<\[])\\(\\*)({self.controls(visitor)})", r"$1$2$3")


@dataclass(frozen=True)
class Visitor:
    """Tokens that a placeholder expands to, by kind of part. More kinds come with more functions."""

    patch: int = 28
    audio_rate: float = 25.0
    page_tokens: int = 512
    more: dict[str, Callable[[Column], Column]] = field(default_factory=dict)

    def image(self, part: Column) -> Column:
        return F.ceil(part["width"] / self.patch) * F.ceil(part["height"] / self.patch)

    def audio(self, part: Column) -> Column:
        return F.ceil(part["seconds"] * self.audio_rate)

    def document(self, part: Column) -> Column:
        return part["pages"].cast("long") * self.page_tokens

    def kinds(self) -> dict[str, Callable[[Column], Column]]:
        return {"image": self.image, "audio": self.audio, "document": self.document, **self.more}

    def attached(self, part: Column) -> Column:
        return F.coalesce(part["kind"].isin(*self.kinds()), F.lit(False))

    def tokens(self, part: Column) -> Column:
        """At least one; a part whose size is not known counts as one."""
        found = F.lit(None).cast("long")
        for kind, visit in self.kinds().items():
            found = F.when(part["kind"] == kind, visit(part).cast("long")).otherwise(found)
        return F.greatest(F.coalesce(found, F.lit(1)), F.lit(1)).cast("long")

    def flattened(self, parts: Column, template: Template) -> Column:
        """The body: escaped texts and placeholders in order."""
        def piece(part: Column, i: Column) -> Column:
            before = F.get(parts, i - 1)
            joint = F.when((i > 0) & ~self.attached(before), F.lit(template.joint)).otherwise(F.lit(""))
            text = template.escaped(F.coalesce(part["text"], F.lit("")), self)
            return F.when(self.attached(part), F.concat(F.lit("<"), part["kind"], F.lit(":"), i.cast("string"),
                                                        F.lit(">"))).otherwise(F.concat(joint, text))

        return F.coalesce(F.array_join(F.transform(parts, piece), ""), F.lit(""))

    def attachments(self, parts: Column) -> Column:
        """part, kind, ref and tokens of all parts but texts, in order."""
        noted = F.transform(parts, lambda p, i: F.struct(
            i.cast("int").alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"), self.tokens(p).alias("tokens"),
            self.attached(p).alias("attached")))
        only = F.transform(F.filter(noted, lambda a: a["attached"]), lambda a: F.struct(
            *[a[c].alias(c) for c in ("part", "kind", "ref", "tokens")]))
        return F.coalesce(only, F.array().cast("array<struct<part:int,kind:string,ref:string,tokens:bigint>>"))

    def split(self, body: Column, template: Template) -> Column:
        """Texts between placeholders and joints, unescaped."""
        between = rf"<(?:{'|'.join(self.kinds())}):[0-9]+>|{re.escape(template.joint)}"
        return F.transform(F.split(body, between), lambda t: template.unescaped(t, self))


def text_part(text: Column) -> Column:
    """A plain text as a list of parts."""
    empty = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in (
        ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int")))
    rest = F.expr(f"struct({empty})")
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"),
                            *[rest[c].alias(c) for c in ("ref", "width", "height", "seconds", "pages")]))


def formatted(turns: DataFrame, key: str, turn: str, role: str, parts: str, template: Template = Template(),
              visitor: Visitor = Visitor()) -> DataFrame:
    """conv, formatted (text), turns (at, start, stop, trained: code points of each turn and of its body), attachments
    (turn, part, kind, ref, tokens) and expanded (tokens of all placeholders), one row per conversation."""
    rows = turns.select(
        F.col(key).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
        F.col(parts).cast(f"array<{PART}>").alias("parts"))
    head = F.concat(F.lit(template.begin), template.escaped(F.col("role"), visitor), F.lit(template.named))
    pieces = rows.select(
        "conv", "turn", "role", F.col("role").isin(*template.trained).alias("trained"), head.alias("head"),
        visitor.flattened(F.col("parts"), template).alias("body"), visitor.attachments(F.col("parts")).alias("attached"),
    )
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "body", "attached")
    whole = F.concat("head", "body", F.lit(template.end))
    stop = F.sum(F.length(whole)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = pieces.select(
        "conv", (F.row_number().over(order) - 1).alias("pos"), whole.alias("piece"),
        (stop - F.length(whole)).alias("at"), (stop - len(template.end)).alias("stop"), F.length("body").alias("n"),
        "trained", "attached")
    one = F.struct("pos", "piece", "at", (F.col("stop") - F.col("n")).alias("start"), "stop", "trained", "attached")
    gathered = placed.groupBy("conv").agg(F.sort_array(F.collect_list(one)).alias("all"))
    noted = F.flatten(F.transform("all", lambda t: F.transform(t["attached"], lambda a: F.struct(
        t["pos"].alias("turn"), *[a[c].alias(c) for c in ("part", "kind", "ref", "tokens")]))))
    return gathered.select(
        "conv", F.array_join(F.transform("all", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("all", lambda t: F.struct(*[t[c].alias(c) for c in ("at", "start", "stop", "trained")])).alias("turns"),
        noted.alias("attachments"),
        F.aggregate(noted, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded"))


def read_back(chats: DataFrame, template: Template = Template(), visitor: Visitor = Visitor()) -> DataFrame:
    """Adds `said`, the turns as the formatted text has them: role, texts (of the text parts), attachments by their
    part, and learnt, what the loss mask covers of the turn (unescaped; null where it covers nothing)."""
    cut = F.split("formatted", re.escape(template.end))
    pieces = F.slice(cut, F.lit(1), F.size(cut) - 1)  # nothing follows the last end

    def turn(z: Column) -> Column:
        piece, at = z["piece"], z["turn"]
        words = F.split(F.substring(piece, len(template.begin) + 1, 2**31 - 1), re.escape(template.named))
        masked = piece.substr((at["start"] - at["at"] + 1).cast("int"), (at["stop"] - at["start"]).cast("int"))
        return F.struct(
            template.unescaped(words[0], visitor).alias("role"), visitor.split(words[1], template).alias("texts"),
            F.when(at["trained"], F.array_join(visitor.split(masked, template), "")).alias("learnt"))

    return chats.withColumn("said", F.transform(
        F.arrays_zip(pieces.alias("piece"), F.col("turns").alias("turn")), turn))


def digests(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars and expanded of what was read back."""
    lines = F.transform("said", lambda t: F.concat(t["role"], F.lit("\n"), F.array_join(t["texts"], ""), F.lit("\n")))
    learnt = F.array_join(F.transform("said", lambda t: F.coalesce(t["learnt"], F.lit(""))), "")
    return chats.select(
        F.col("conv").alias("conv_id"), F.size("said").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"), F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"), F.col("expanded").alias("expanded_tokens"))
