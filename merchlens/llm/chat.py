"""Chat formatting with Spark expressions only.

Turns are collected per conversation, sorted, adjacent turns of one role are merged into a block, and blocks become a
string between control strings. Control strings inside roles and texts are escaped so that the output can be read back
exactly, and a mask tells which parts a model should learn from.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Control strings of the output, further strings that must not appear raw in a text, and the role to learn from.

    A block is begin, role, after_role, texts joined by `between`, and end.
    """

    begin: str = "<|begin|>"
    after_role: str = "<|text|>"
    between: str = "<|next|>"
    end: str = "<|end|>"
    reserved: tuple[str, ...] = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>")
    learn: str = "assistant"

    def controls(self) -> tuple[str, ...]:
        """All strings that are escaped; the own ones share their first two characters, which is what is escaped."""
        return ("<|", *self.reserved)

    def check(self) -> None:
        if not all(c.startswith("<|") for c in (self.begin, self.after_role, self.between, self.end)):
            raise ValueError("control strings of the template start with <|")


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() else f"\\{c}" for c in text)


def escape(text: Column, template: Template) -> Column:
    """Put one more backslash after the first character of every control string, with or without backslashes there.

    Each replacement has an inverse and never forms another control string, so undoing them in reverse order gives
    back exactly the text.
    """
    for control in template.controls():
        first, rest = _quoted(control[0]), _quoted(control[1:])
        text = F.regexp_replace(text, F.lit(f"({first}\\\\*)({rest})"), F.lit("$1\\\\$2"))
    return text


def unescape(text: Column, template: Template) -> Column:
    for control in reversed(template.controls()):
        first, rest = _quoted(control[0]), _quoted(control[1:])
        text = F.regexp_replace(text, F.lit(f"({first}\\\\*)\\\\({rest})"), F.lit("$1$2"))
    return text


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, formatted, segments) per conversation.

    `turns` has conv_id, turn, role, text; a NULL role or text counts as empty, a NULL turn comes first, and rows of the
    same turn are ordered by role and text, repeated rows kept. Rows with NULL conv_id form one conversation. `formatted`
    is the whole string; `segments` are its consecutive parts with a flag that is set for the texts of the learned role
    and nothing else. Both are values of one row, so a conversation is as large as its text. No rows give no rows.
    """
    template.check()
    role = escape(F.coalesce(F.col("role").cast("string"), F.lit("")), template)
    text = escape(F.coalesce(F.col("text").cast("string"), F.lit("")), template)
    learned = F.coalesce(F.col("role").cast("string") == template.learn, F.lit(False))
    rows = turns.select(
        "conv_id", F.struct(F.col("turn"), role.alias("role"), text.alias("text"), learned.alias("learned")).alias("t")
    )
    sorted_turns = F.sort_array(F.collect_list("t"))
    grouped = rows.groupBy("conv_id").agg(sorted_turns.alias("turns"))
    turn = F.col("turns")

    def parts(t: Column, i: Column) -> Column:
        # The turn before, or the turn itself for the first, which starts a block in any case.
        before = F.get(turn, F.greatest(i - 1, F.lit(0)))
        starts = (i == 0) | (before["role"] != t["role"])
        opening = F.concat(F.lit(template.begin), t["role"], F.lit(template.after_role))
        closing = F.when(i == 0, F.lit("")).otherwise(F.lit(template.end))
        head = F.when(starts, F.concat(closing, opening)).otherwise(F.lit(template.between))
        return F.array(
            F.struct(head.alias("part"), F.lit(False).alias("learned")), F.struct(t["text"].alias("part"), t["learned"].alias("learned"))
        )

    last = F.array(F.struct(F.lit(template.end).alias("part"), F.lit(False).alias("learned")))
    segments = F.concat(F.flatten(F.transform(turn, parts)), last)
    return grouped.select("conv_id", segments.alias("segments")).select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["part"]), "").alias("formatted"), "segments"
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted string: an array of (role, text), merged turns apart again."""
    blocks = F.split(formatted, _quoted(template.end))
    # What follows the last end is empty.
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        halves = F.split(block, _quoted(template.after_role))
        role = unescape(F.substr(halves[0], F.lit(len(template.begin) + 1)), template)
        texts = F.split(halves[1], _quoted(template.between))
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t, template).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def learned_text(segments: Column, template: Template = Template()) -> Column:
    """All text under the mask, unescaped, nothing in between."""
    texts = F.transform(F.filter(segments, lambda s: s["learned"]), lambda s: unescape(s["part"], template))
    return F.array_join(texts, "")


def digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """What the formatted output holds, read back from it: numbers and hashes of turns and of learned text."""
    turns = read_turns(F.col("formatted"), template)
    # Read from the string itself; it is what the mask of the segments covers.
    texts = F.transform(F.filter("turns", lambda t: t["role"] == template.learn), lambda t: t["text"])
    read = formatted.select("conv_id", turns.alias("turns"), "formatted").withColumn("learned", F.array_join(texts, ""))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
