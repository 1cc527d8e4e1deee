"""Chat formatting with Spark expressions: sorted turns, merged blocks, escaped texts, and the way back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks of a block: its start, the end of its role, a break between two turns, its end. No mark lies in a text."""

    start: str = "<|start|>"
    role_end: str = "<|says|>"
    turn_break: str = "<|next|>"
    end: str = "<|end|>"
    learned_role: str = "assistant"

    # Every control string of this and of the common templates begins with one of these characters.
    def escape(self, text: Column) -> Column:
        text = F.replace(text, F.lit("&"), F.lit("&amp;"))
        text = F.replace(text, F.lit("<"), F.lit("&lt;"))
        return F.replace(text, F.lit("["), F.lit("&lsqb;"))

    def unescape(self, text: Column) -> Column:
        text = F.replace(text, F.lit("&lsqb;"), F.lit("["))
        text = F.replace(text, F.lit("&lt;"), F.lit("<"))
        return F.replace(text, F.lit("&amp;"), F.lit("&"))


def format_conversations(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (array of text and loss flag), ``formatted``.

    Turns are sorted by turn, role and text, nulls first; adjacent turns of one role share a block. Null roles and
    texts are empty, a null conv_id is one conversation. ``formatted`` is all segments in a row; the segments with the
    flag are the texts of the learned role. No rows in, no rows out; other columns are not read.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sorted_turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    counted = sorted_turns.select(
        "conv_id",
        "turns",
        F.expr(
            "filter(sequence(0, size(turns) - 1), i -> i = 0 or turns[i].role != turns[greatest(i - 1, 0)].role)"
        ).alias("starts"),
    )
    blocks = counted.select(
        "conv_id",
        F.expr(
            "transform(starts, (s, b) -> slice(turns, s + 1, if(b + 1 < size(starts), starts[b + 1], size(turns)) - s))"
        ).alias("blocks"),
    )
    mark = lambda *parts: F.struct(F.concat(*parts).alias("text"), F.lit(False).alias("loss"))

    def rendered(block: Column) -> Column:
        role = block[0]["role"]

        def segments(x: Column, i: Column) -> Column:
            before = F.when(i == 0, F.concat(F.lit(template.start), template.escape(role), F.lit(template.role_end)))
            text = F.struct(template.escape(x["text"]).alias("text"), (role == template.learned_role).alias("loss"))
            return F.array(mark(before.otherwise(F.lit(template.turn_break))), text)

        return F.concat(F.flatten(F.transform(block, segments)), F.array(mark(F.lit(template.end))))

    return blocks.select("conv_id", F.flatten(F.transform("blocks", rendered)).alias("segments")).select(
        "conv_id", "segments", F.array_join(F.col("segments.text"), "").alias("formatted")
    )


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id``, ``turns`` (role and text, unescaped, from ``formatted``) and ``learned`` (texts under the mask)."""
    quoted = lambda mark: "\\Q" + mark + "\\E"

    def turns(block: Column) -> Column:
        parts = F.split(block, quoted(template.role_end), 2)
        role = template.unescape(F.substr(parts[0], F.lit(len(template.start) + 1)))
        texts = F.split(parts[1], quoted(template.turn_break), -1)
        return F.transform(
            texts, lambda t: F.struct(role.alias("role"), template.unescape(t).alias("text"))
        )

    blocks = F.filter(F.split("formatted", quoted(template.end), -1), lambda b: b != "")
    learned = F.transform(
        F.filter("segments", lambda s: s["loss"]), lambda s: template.unescape(s["text"])
    )
    return formatted.select(
        "conv_id", F.flatten(F.transform(blocks, turns)).alias("turns"), learned.alias("learned"), "formatted"
    )
