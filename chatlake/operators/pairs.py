"""Reply pairs: a friend's message and the own message right behind it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.functions import text as tx
from chatlake.operators.conversations import chat_message
from chatlake.operators.numbering import (
    BLOCK_ROWS,
    HOT_ROWS,
    block_window,
    neighbour_blocks,
    number_rows,
    previous,
)


def reply_pairs(
    rows: DataFrame,
    key: str = "chat_id",
    position: str = "message_index",
    self_role: str = "self",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`key, position, context, question, reply` for flat rows of `role` and `content`.

    `position` has to be dense within the key and points at the friend's message in the
    result. `context` holds the friend's and the own message before it when these two are
    an exchange themselves, else it is empty.
    """
    window = block_window(position, key)

    def role(steps):
        return previous("role", window, steps)

    def content(steps):
        return previous("content", window, steps)

    blocks = neighbour_blocks(
        rows.select(key, position, "role", "content"), position, 3, block_rows
    )
    looked_back = blocks.select(
        key,
        position,
        "is_own",
        "role",
        F.col("content").alias("reply"),
        role(1).alias("_role_1"),
        content(1).alias("question"),
        role(2).alias("_role_2"),
        content(2).alias("_context_reply"),
        role(3).alias("_role_3"),
        content(3).alias("_context_question"),
    )
    is_pair = (F.col("role") == self_role) & (F.col("_role_1") == "friend")
    has_context = (F.col("_role_2") == self_role) & (F.col("_role_3") == "friend")
    exchange = F.array(
        chat_message("user", F.col("_context_question")),
        chat_message("assistant", F.col("_context_reply")),
    )
    return looked_back.filter(F.col("is_own") & is_pair).select(
        key,
        (F.col(position) - 1).alias(position),
        F.when(has_context, exchange)
        .otherwise(F.array().cast("array<struct<role:string,content:string>>"))
        .alias("context"),
        "question",
        "reply",
    )


def cleaned_pairs(cleaned: DataFrame, block_rows: int = BLOCK_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """`reply_pairs` of cleaned messages, of however many batches, in order of time and id.

    `position` counts all of a chat's messages; `message_index` may restart with every batch.
    """
    rows = cleaned.select(
        "chat_id",
        "timestamp",
        "message_id",
        tx.party_role(F.col("is_from_me")).alias("role"),
        F.col("text").alias("content"),
    )
    placed = number_rows(rows, "chat_id", ("timestamp", "message_id"), hot_rows=hot_rows)
    return reply_pairs(placed, position="position", block_rows=block_rows)


def pair_messages(prompt: Column | str) -> Column:
    """System message, context, question and reply as one array."""
    return F.concat(
        F.array(chat_message("system", prompt)),
        F.col("context"),
        F.array(
            chat_message("user", F.col("question")), chat_message("assistant", F.col("reply"))
        ),
    )


def pair_line(prompt: Column | str) -> Column:
    """JSON line `{"messages"}` of one pair."""
    return F.to_json(F.struct(pair_messages(prompt).alias("messages")))
