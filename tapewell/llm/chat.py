"""Conversations as one marked-up text with a loss mask, by Spark expressions only.

The turns of a conversation are collected, sorted, and neighbours of one role merged into
a block. A formatted conversation is a list of segments, each under the loss mask or not:

    <|turn|>role
    text<|next|>text<|end|>
    <|turn|>role ...

``<|next|>`` parts the texts of merged turns, so that every turn can be read back. Control
strings inside roles and texts, of this template and of others, get a backslash after
their first character, and a backslash is doubled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .native import let

# Marks of this template, and control strings of known ones.
TURN, NEXT, END = "<|turn|>", "<|next|>", "<|end|>"
_CONTROL = r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\]))"
_ROLE = r"(?s)^((?:[^\n\\]++|\\.)*+)\n"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\")


def _escape_role(role: Column) -> Column:
    """A role ends its line, so line breaks in it are escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    """What :func:`escape` was given: a backslash goes, the character after it stays."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _blocks(turns: Column) -> Column:
    """Neighbouring turns of one role as (role, texts)."""

    def merged(starts: Column) -> Column:
        return F.transform(
            starts,
            lambda s, r: F.struct(
                F.get(turns, s)["role"].alias("role"),
                F.transform(
                    F.slice(turns, s + 1, F.coalesce(F.get(starts, r + 1), F.size(turns)) - s), lambda t: t["text"]
                ).alias("texts"),
            ),
        )

    return let(
        F.filter(
            F.sequence(F.lit(0), F.size(turns) - 1),
            lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
        ),
        merged,
    )


def _segment(text: Column, loss: Column | bool) -> Column:
    return F.struct(text.alias("text"), (F.lit(loss) if isinstance(loss, bool) else loss).alias("loss"))


def _segments(blocks: Column) -> Column:
    """Marks and texts in order; a text is a segment of its own, also an empty one."""

    def of_block(block: Column) -> Column:
        return F.flatten(
            F.transform(
                block["texts"],
                lambda text, k: F.array(
                    _segment(
                        F.when(k == 0, F.concat(F.lit(TURN), _escape_role(block["role"]), F.lit("\n"))).otherwise(F.lit(NEXT)),
                        False,
                    ),
                    _segment(escape(text), block["role"] == LEARNED_ROLE),
                ),
            )
        )

    return F.flatten(
        F.transform(blocks, lambda b: F.concat(of_block(b), F.array(_segment(F.lit(END + "\n"), False))))
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, segments, formatted) per conversation of (conv_id, turn, role, text).

    Turns go by number, nulls first; turns of one number by role, then text. Null texts and
    roles are empty. Rows without a conversation are one conversation, the null one.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    sorted_turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return (
        rows.groupBy("conv_id")
        .agg(sorted_turns.alias("turns"))
        .select("conv_id", _segments(_blocks(F.col("turns"))).alias("segments"))
        .select(
            "conv_id",
            "segments",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        )
    )


def _read_turns(formatted: Column) -> Column:
    """(role, text) of every turn of a formatted conversation."""

    def of_block(block: Column) -> Column:
        role = F.regexp_extract(block, _ROLE, 1)
        body = F.substr(block, F.char_length(role) + 2)
        texts = F.split(F.regexp_replace(body, r"<\|end\|>\n\z", ""), r"<\|next\|>", -1)
        return F.transform(
            texts, lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text"))
        )

    parts = F.split(formatted, r"<\|turn\|>", -1)
    return F.flatten(F.transform(F.slice(parts, 2, F.size(parts) - 1), of_block))


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Digests of turns, learned text and length, all read back from (conv_id, segments, formatted)."""
    learned = F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), ""
    )
    return (
        formatted.select("conv_id", "formatted", learned.alias("learned"), _read_turns(F.col("formatted")).alias("turns"))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(
                F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
                256,
            ).alias("turns_sha256"),
            F.char_length("learned").cast("long").alias("loss_chars"),
            F.sha2("learned", 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def control_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts are another template's control strings."""
    text = "</s>[INST] ok [/INST]"
    return spark.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string"
    )
