"""Assembly of conversations and training examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.functions import text as tx
from chatlake.functions.clock import integer_div
from chatlake.operators.numbering import number_rows


def chat_message(role: Column | str, content: Column | str) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    content = F.lit(content) if isinstance(content, str) else content
    return F.struct(role.alias("role"), content.alias("content"))


def assemble(
    rows: DataFrame,
    key: Sequence[str],
    index: str,
    tie: str,
    message: Sequence[str],
    part_messages: int | None = None,
) -> DataFrame:
    """Collect each conversation's messages in order of `index`, then `tie`, with its `total`.

    A conversation is one row with `part` 0. Where rows that long are not wanted,
    `part_messages` cuts it into rows of at most so many messages, with `part` 0, 1, ..., which
    in order are the whole conversation; messages are counted in their order, whatever
    their index is, and the first of `key` has to be the conversation's.
    """
    if part_messages is None:
        placed = rows.withColumn("part", F.lit(0).cast("long"))
        total = F.count(F.lit(1))
    else:
        placed = number_rows(rows, key[0], (index, tie), position="_position", total="_total")
        placed = placed.withColumn("part", integer_div(F.col("_position"), part_messages))
        total = F.max("_total")
    entry = F.struct(index, tie, F.struct(*message).alias("message"))
    ordered = F.array_sort(F.collect_list(entry))
    return placed.groupBy(*key, "part").agg(
        F.transform(ordered, lambda item: item["message"]).alias("messages"), total.alias("total")
    )


def conversations(cleaned: DataFrame, part_messages: int | None = None) -> DataFrame:
    """`conversation_id, part, messages, total` with assistant and user roles."""
    rows = cleaned.select(
        "chat_id",
        "conversation_id",
        "message_index",
        "message_id",
        tx.chat_role(F.col("is_from_me")).alias("role"),
        F.col("text").alias("content"),
    )
    # Grouped by chat as well, since rows numbered per chat are already together then.
    assembled = assemble(
        rows,
        ["chat_id", "conversation_id"],
        "message_index",
        "message_id",
        ["role", "content"],
        part_messages,
    )
    return assembled.drop("chat_id")


def lead_with_system(messages: Column, part: Column, prompt: Column | str) -> Column:
    """Put the system message before the first message of a conversation."""
    opening = F.array(chat_message("system", prompt))
    return F.when(part == 0, F.concat(opening, messages)).otherwise(messages)


def training_examples(
    cleaned: DataFrame,
    prompt: Column | str,
    min_messages: int = 3,
    part_messages: int | None = None,
) -> DataFrame:
    """Conversations of at least `min_messages`, opened by the system prompt."""
    return (
        conversations(cleaned, part_messages)
        .filter(F.col("total") >= min_messages)
        .withColumn("messages", lead_with_system(F.col("messages"), F.col("part"), prompt))
    )


def example_line(key: str = "conversation_id") -> Column:
    """JSON line `{"id", "messages"}`; lines after the first of a conversation add `"part"`."""
    later_part = F.when(F.col("part") > 0, F.col("part"))
    return F.to_json(F.struct(F.col(key).alias("id"), later_part.alias("part"), F.col("messages")))


def conversation_sizes(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("message_count"))


def conversation_stats(cleaned: DataFrame) -> DataFrame:
    """Messages, own messages and media messages per conversation."""
    return cleaned.groupBy("conversation_id").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.count_if(F.col("is_from_me") == 1).alias("own_count"),
        F.count_if(F.col("has_media") == 1).alias("media_count"),
    )


def normalize_roles(documents: DataFrame, self_role: str = "self") -> DataFrame:
    """Keep role and content; own messages become the assistant's, all others the user's."""

    def normalized(message: Column) -> Column:
        is_self = message["role"].eqNullSafe(F.lit(self_role))
        role = F.when(is_self, F.lit("assistant")).otherwise(F.lit("user"))
        return chat_message(role, message["content"])

    return documents.withColumn("messages", F.transform("messages", normalized))
