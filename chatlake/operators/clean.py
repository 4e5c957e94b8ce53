"""Extracted messages to cleaned, numbered messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.functions import text as tx
from chatlake.operators.numbering import HOT_ROWS, number_rows


def keep_clean(rows: DataFrame, text: str = "text", cleaned: str = "text") -> DataFrame:
    """Rows whose text is neither reaction nor notice nor blank, with the cleaned text.

    Lower case and cleaned text are computed once per row, and only for rows that passed the
    cheaper rules.
    """
    value = F.col(text)
    kept = rows.filter(value.isNotNull() & ~tx.is_reaction(value))
    kept = kept.select("*", tx.once(F.lower(value)).alias("_lowered"))
    kept = kept.filter(~tx.is_system_notice(F.col("_lowered")))
    kept = kept.select("*", tx.once(tx.strip_placeholder(value)).alias("_cleaned"))
    kept = kept.filter(F.col("_cleaned") != "").withColumn(cleaned, F.col("_cleaned"))
    return kept.drop("_lowered", "_cleaned")


def clean(
    messages: DataFrame,
    after: int | None = None,
    earlier: DataFrame | None = None,
    sizes: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Cleaned messages with conversation id and 0-based index by time within the chat.

    The index restarts at 0 in every batch. Given `earlier`, the `chat_sizes` of the rows
    cleaned before, it goes on behind these instead. `sizes` is as in `number_rows`.
    """
    if after is not None:
        messages = messages.filter(F.col("message_id") > F.lit(after))
    kept = keep_clean(messages).select(
        "message_id", "chat_id", "text", "timestamp", "is_from_me", "contact_id", "has_media"
    )
    numbered = number_rows(
        kept,
        "chat_id",
        ("timestamp", "message_id"),
        position="message_index",
        sizes=messages if sizes is None else sizes,
        hot_rows=hot_rows,
    )
    if earlier is not None:
        numbered = _continue_index(numbered, earlier)
    return numbered.select(
        "message_id",
        "chat_id",
        "text",
        "timestamp",
        "is_from_me",
        "contact_id",
        "has_media",
        F.current_timestamp().alias("cleaned_at"),
        tx.conversation_id(F.col("chat_id")).alias("conversation_id"),
        "message_index",
    )


def chat_sizes(cleaned: DataFrame) -> DataFrame:
    """Cleaned rows per chat."""
    return cleaned.groupBy("chat_id").agg(F.count(F.lit(1)).alias("message_count"))


def _continue_index(numbered, earlier):
    offsets = earlier.groupBy("chat_id").agg(F.sum("message_count").alias("_offset"))
    return numbered.join(offsets, "chat_id", "left").withColumn(
        "message_index", F.col("message_index") + F.coalesce(F.col("_offset"), F.lit(0))
    )
