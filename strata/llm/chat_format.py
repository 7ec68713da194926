"""Chat formatting with typed content parts.

A turn's content is an array of typed parts (``PART_TYPE``). A visitor, one
method a kind, flattens the parts in order: every kind but text becomes one
placeholder, an attachment record (where it stands, what it refers to) and
the number of tokens the placeholder expands to. Neighbouring texts are one
run, escaped as a whole, so that no control string can be put together from
two parts. Turns are rendered row by row before the shuffle; one ordered
concatenation then builds each conversation, so a conversation is one row by
definition and only rendered text is shuffled.

Escaping is reversible: a control string in a text gets one escape
character after its first character; if the text already has ``k`` escape
characters there, it gets one more. A rendered text therefore never holds a
control string, and removing one escape character restores it.

Defined results: null text, role or parts are empty; a null turn sorts
first; turns with the same number are ordered by role, then rendered
content, and repeated rows are all kept; a null conversation id is one
conversation; texts of any length are rendered whole; an empty table gives
no rows; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: One content part. ``size`` is what a kind's expansion is counted from:
#: pixels as (width, height), seconds as (seconds, 0), pages as (pages, 0).
PART_TYPE = "struct<kind:string,text:string,ref:string,size:struct<a:bigint,b:bigint>>"


@dataclass(frozen=True)
class Template:
    """Markers of the rendered form. ``others`` are control strings of
    common chat formats which texts must not smuggle in either."""

    turn_start: str = "<|im_start|>"
    role_end: str = "<|im_sep|>"
    turn_end: str = "<|im_end|>"
    placeholders: tuple[tuple[str, str], ...] = (("image", "<|image|>"), ("audio", "<|audio|>"), ("document", "<|document|>"))
    others: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
    escape: str = "\u2060"
    train_roles: tuple[str, ...] = ("assistant",)

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.turn_start, self.role_end, self.turn_end, *[p for _, p in self.placeholders], *self.others)

    def __post_init__(self) -> None:
        for c in self.controls:
            if len(c) < 2 or self.escape in c:
                raise ValueError(f"control string {c!r}: two characters at least, no escape character")

    def _pattern(self, least: str) -> str:
        """(first character, escape characters before the rest). The rest is
        looked ahead at, so matches cannot hide one another."""
        ways = "|".join(f"{re.escape(c[0])}(?={self.escape}*{re.escape(c[1:])})" for c in self.controls)
        return f"({ways})({self.escape}{least})"


class PartVisitor:
    """Native expressions for one part, by kind. Subclass to change how a
    kind is rendered or how many tokens it expands to."""

    #: Edge of an image patch, audio frames a second, tokens a page.
    patch, frames, page_tokens = 28, 25, 256

    def __init__(self, template: Template) -> None:
        self.t = template

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self.t._pattern("*")), F.lit(f"$1$2{self.t.escape}"))

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self.t._pattern("*") + self.t.escape), F.lit("$1$2"))

    def text(self, part: Column) -> tuple[Column, Column]:
        body = F.coalesce(part["text"], F.lit(""))
        return body, F.regexp_count(body, F.lit(r"[\p{L}\p{M}]+|\p{N}|[^\s\p{L}\p{M}\p{N}]")).cast("long")

    def image(self, part: Column) -> Column:
        cells = [F.ceil(F.greatest(F.coalesce(part["size"][x], F.lit(0)), F.lit(1)) / F.lit(self.patch)) for x in ("a", "b")]
        return (cells[0] * cells[1]).cast("long")

    def audio(self, part: Column) -> Column:
        return F.coalesce(part["size"]["a"], F.lit(0)).cast("long") * F.lit(self.frames)

    def document(self, part: Column) -> Column:
        return F.coalesce(part["size"]["a"], F.lit(0)).cast("long") * F.lit(self.page_tokens)

    def visit(self, part: Column) -> Column:
        """struct(rendered, tokens, kind, ref) of a part, texts as they are;
        an unknown kind is read as text."""
        body, tokens = self.text(part)
        kind = F.lit("text")
        for name, mark in self.t.placeholders:
            here = part["kind"] == name
            body = F.when(here, F.lit(mark)).otherwise(body)
            tokens = F.when(here, getattr(self, name)(part)).otherwise(tokens)
            kind = F.when(here, F.lit(name)).otherwise(kind)
        return F.struct(body.alias("rendered"), tokens.alias("tokens"), kind.alias("kind"), part["ref"].alias("ref"))


def text_parts(text: Column) -> Column:
    """A plain text as an array with one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("struct<a:bigint,b:bigint>").alias("size")))


@dataclass(frozen=True)
class ChatFormatter:
    template: Template = field(default_factory=Template)
    visitor: type[PartVisitor] = PartVisitor

    def format(self, turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
        """One row a conversation: ``formatted``; ``loss_spans`` (start and
        end code points of the texts to learn); ``attachments`` (turn index,
        part index, kind, ref, position of the placeholder, tokens);
        ``n_tokens`` (with placeholders expanded) and ``n_turns``."""
        t, v = self.template, self.visitor(self.template)
        who = F.coalesce(F.col(role), F.lit(""))
        seen = F.transform(F.coalesce(F.col(parts), F.array().cast(f"array<{PART_TYPE}>")), v.visit)
        rendered = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), who.alias("role"), seen.alias("seen"))
        # places of the placeholders, with one before and one after all parts
        marks = F.filter(F.transform("seen", lambda p, k: F.when(p["kind"] != "text", k)), lambda k: k.isNotNull())
        rendered = rendered.withColumn("edges", F.concat(F.array(F.lit(-1)), marks, F.array(F.size("seen"))))
        between = lambda j: F.slice("seen", F.get("edges", j) + 2, F.get("edges", j + 1) - F.get("edges", j) - 1)
        run = lambda j: v.escape(F.array_join(F.transform(between(j), lambda p: p["rendered"]), ""))
        rendered = rendered.withColumns({"runs": F.transform(F.sequence(F.lit(0), F.size("edges") - 2), run), "held": F.filter("seen", lambda p: p["kind"] != "text")})
        body = F.concat(F.array_join(F.transform("held", lambda p, j: F.concat(F.get("runs", j), p["rendered"])), ""), F.element_at("runs", -1))
        head = F.concat(F.lit(t.turn_start), v.escape(F.col("role")), F.lit(t.role_end))
        tokens = F.aggregate("seen", F.lit(0).cast("long"), lambda a, p: a + p["tokens"])
        rendered = rendered.select("conv_id", "turn", "role", "held", "edges", F.transform("runs", F.length).alias("sizes"), tokens.alias("tokens"), body.alias("body"), head.alias("head"))
        size = F.length("head") + F.length("body") + len(t.turn_end)
        # one sort in each conversation gives the turns' order and places
        order = Window.partitionBy("conv_id").orderBy("turn", "role", "body", "held", "edges")
        before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = rendered.withColumn("i", F.row_number().over(order) - 1).withColumn("start", before + F.length("head"))
        passed = lambda j: F.aggregate(F.slice("held", F.lit(1), j), F.get("sizes", j), lambda a, p: a + F.length(p["rendered"])) + F.aggregate(F.slice("sizes", F.lit(1), j), F.lit(0), lambda a, x: a + x)
        found = F.transform(
            "held",
            lambda p, j: F.struct(
                F.col("i").cast("long").alias("turn"), F.get("edges", j + 1).cast("long").alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"),
                (F.col("start") + passed(j)).alias("position"), p["tokens"].alias("tokens"),
            ),
        )
        span = F.struct(F.col("start").alias("start"), (F.col("start") + F.length("body")).alias("end"))
        row = F.struct(
            "i",
            F.concat("head", "body", F.lit(t.turn_end)).alias("piece"),
            F.when(F.col("role").isin(*t.train_roles), span).alias("span"),
            found.alias("attached"),
            "tokens",
        )
        whole = placed.select("conv_id", row.alias("row")).groupBy("conv_id").agg(
            F.sort_array(F.collect_list("row")).alias("rows"), F.sum("row.tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_turns"))
        return whole.select(
            "conv_id",
            F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
            F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
            F.flatten(F.transform("rows", lambda r: r["attached"])).alias("attachments"),
            "n_tokens",
            "n_turns",
        )

    def turns(self, formatted: Column) -> Column:
        """Reads the rendered form back: array of struct(role, text)."""
        t, v = self.template, self.visitor(self.template)
        pieces = F.split(formatted, re.escape(t.turn_end))
        pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
        inner = F.transform(pieces, lambda p: F.split(F.substring(p, F.lit(len(t.turn_start) + 1), F.length(p)), re.escape(t.role_end), 2))
        return F.transform(inner, lambda p: F.struct(v.unescape(F.get(p, 0)).alias("role"), v.unescape(F.get(p, 1)).alias("text")))

    def learned(self, formatted: Column, spans: Column) -> Column:
        """All text under the loss mask, unescaped, span by span."""
        v = self.visitor(self.template)
        cut = lambda s: F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        return F.array_join(F.transform(spans, lambda s: v.unescape(cut(s))), "")
