"""Conversation turns to pairs, and messages to chat text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexmill.functions.columns import idiv

TURN_BLOCK = 1024
# The chat markup around each message.
MESSAGE_START, MESSAGE_END = "<|im_start|>", "<|im_end|>\n"


def message(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def render_messages(messages: Column) -> Column:
    """Array of (role, content) to one marked-up text."""
    one = lambda m: F.concat(F.lit(MESSAGE_START), m["role"], F.lit("\n"), m["content"], F.lit(MESSAGE_END))
    return F.array_join(F.transform(messages, one), "")


def chat_format_pairs(pairs: DataFrame, source: str = "inputs", target: str = "targets") -> DataFrame:
    """Add ``text``: a user message and the assistant's answer."""
    both = F.array(message("user", F.col(source)), message("assistant", F.col(target)))
    return pairs.withColumn("text", render_messages(both))


def choose_text(df: DataFrame, field: str, keep: list[str] | None = None) -> DataFrame:
    return df.select(*(keep or []), F.col(field).alias("text"))


def next_turn(turns: DataFrame) -> DataFrame:
    """Add ``next_role`` and ``next_text`` of the following turn of the same conversation.

    A conversation is handled in blocks of `TURN_BLOCK` turn numbers, so that one with very many
    turns is spread over many tasks. The last turn of a block takes the first turn of the next block.
    """
    blocks = turns.withColumn("_block", idiv(F.col("turn"), TURN_BLOCK))
    in_block = W.partitionBy("conv_id", "_block").orderBy("turn")
    pair = F.struct("role", "text")
    linked = blocks.withColumn("_next", F.lead(pair).over(in_block))
    # One row per block: its first turn, handed to the block before it.
    firsts = blocks.groupBy("conv_id", "_block").agg(F.min_by(pair, "turn").alias("_handed"))
    after = F.lead("_block").over(W.partitionBy("conv_id").orderBy("_block"))
    links = blocks.select("conv_id", "_block").distinct().withColumn("_after", after)
    handed = links.join(firsts.withColumnRenamed("_block", "_after"), ["conv_id", "_after"]).drop("_after")
    found = F.coalesce(F.col("_next"), F.col("_handed"))
    return (
        linked.join(handed, ["conv_id", "_block"], "left")
        .withColumns({"next_role": found["role"], "next_text": found["text"]})
        .drop("_block", "_next", "_handed")
    )


def turns_to_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, inputs, targets): each user turn that an assistant turn follows."""
    answered = (F.col("role") == "user") & (F.col("next_role") == "assistant")
    return next_turn(turns).filter(answered).select(
        "conv_id", "turn", F.col("text").alias("inputs"), F.col("next_text").alias("targets")
    )


def chat_format_full(turns: DataFrame) -> DataFrame:
    """(conv_id, text): all messages of a conversation in order, one row whatever its length.

    Messages are first rendered in blocks of `TURN_BLOCK` turn numbers, so the turns of a very long conversation are
    sorted and joined in many tasks; what meets in one row is a text per block.
    """
    blocks = turns.groupBy("conv_id", idiv(F.col("turn"), TURN_BLOCK).alias("part"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    parts = blocks.agg(render_messages(ordered).alias("text"))
    whole = F.array_sort(F.collect_list(F.struct("part", "text")))
    return parts.groupBy("conv_id").agg(F.array_join(F.transform(whole, lambda p: p["text"]), "").alias("text"))
