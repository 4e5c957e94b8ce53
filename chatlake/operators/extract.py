"""Source tables to extracted messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.functions import text as tx
from chatlake.functions.clock import source_timestamp
from chatlake.session import stored
from chatlake.sources.tables import ChatSource

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20


def has_content(text, body, attachments):
    """Text, or a body to decode on a message without attachments."""
    return text.isNotNull() | (body.isNotNull() & (attachments == 0))


def considered(message: DataFrame) -> DataFrame:
    """Source messages with content and neither flag set."""
    text, body = F.col("text"), F.col("attributedBody")
    return message.filter(has_content(text, body, F.col("cache_has_attachments"))).filter(
        (F.col("is_system_message") == 0) & (F.col("is_emote") == 0)
    )


def new_messages(source: ChatSource, after: int | None = None) -> DataFrame:
    """Messages above the mark with content and neither flag set, text resolved."""
    message = source.message
    if after is not None:
        message = message.filter(F.col("row_id") > F.lit(after))
    return considered(message).select(
        F.col("row_id").alias("message_id"),
        tx.once(tx.resolve_text(F.col("text"), F.col("attributedBody"))).alias("text"),
        source_timestamp(F.col("date")).alias("timestamp"),
        "is_from_me",
        "handle_id",
        F.col("cache_has_attachments").alias("has_media"),
        "cache_roomnames",
    )


def usable(text):
    return text.isNotNull() & ~tx.is_reaction(text)


def with_context(message: DataFrame, source: ChatSource) -> DataFrame:
    """Join chat and contact. Chat names travel with the narrow link rows, so the rows
    with text are shuffled by message id only."""
    joined = message.join(with_chat_names(source.link, source.chat), "message_id")
    return with_contact(joined, source).select(
        "message_id",
        "chat_id",
        "text",
        "timestamp",
        "is_from_me",
        "contact_id",
        "has_media",
        F.current_timestamp().alias("processed_at"),
        "chat_name",
        tx.room_name(F.col("chat_room_name"), F.col("cache_roomnames")).alias("room_name"),
    )


def extract(source: ChatSource, after: int | None = None) -> DataFrame:
    """Usable messages with an id above `after`."""
    return with_context(new_messages(source, after).filter(usable(F.col("text"))), source)


def candidates(source: ChatSource, after: int | None = None) -> DataFrame:
    """As `extract`, but rows with unusable text stay, with a null text.

    The progress mark counts these rows too; the texts themselves need not be shuffled.
    """
    message = new_messages(source, after).withColumn(
        "text", F.when(~tx.is_reaction(F.col("text")), F.col("text"))
    )
    return with_context(message, source)


def with_chat_names(links: DataFrame, chat: DataFrame) -> DataFrame:
    """Rows whose chat exists, with its display and room name."""
    names = chat.select(
        F.col("row_id").alias("chat_id"),
        F.col("display_name").alias("chat_name"),
        F.col("room_name").alias("chat_room_name"),
    )
    return links.join(names, "chat_id")


def chat_lookup(rows: DataFrame, chat: DataFrame) -> DataFrame:
    """Names by chat id on any rows; unknown chats get nulls."""
    names = chat.select(
        F.col("row_id").alias("chat_id"),
        F.col("display_name").alias("chat_name"),
        F.col("room_name").alias("chat_room_name"),
    )
    return rows.join(names, "chat_id", "left")


def with_contact(
    rows: DataFrame, source: ChatSource, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """`contact_id` by handle id for rows with `message_id, handle_id`; null if unknown.

    A contact table of up to `broadcast_rows` and BROADCAST_BYTES, which is measured, is broadcast. Beyond that
    the contacts are found for ids alone and come back by message id: rows with text are
    already shuffled by it, and are not shuffled again. Ids outside the contacts' range take
    no part in that; among them is the one that all own messages share.
    """
    contacts = contact_ids(source.handle)
    handle_id = F.col("handle_id")
    contact_count, size, lowest, highest = contacts.agg(
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.octet_length("contact_id") + 16), F.lit(0)),
        F.min(handle_id),
        F.max(handle_id),
    ).first()
    if contact_count <= broadcast_rows and size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(contacts), "handle_id", "left")
    # Stored, so that both sides of the join are plain shuffles, which can be split where they are skewed.
    contacts = stored(contacts)
    found = (
        source.message.select(F.col("row_id").alias("message_id"), "handle_id")
        .filter(handle_id.between(lowest, highest))
        .join(contacts, "handle_id")
        .groupBy("message_id")  # one row per message, so an unused contact is not joined at all
        .agg(F.max("contact_id").alias("contact_id"))
    )
    return rows.join(found, "message_id", "left")


def contact_ids(handle: DataFrame) -> DataFrame:
    """One contact for each handle id: the last in order where an id is repeated."""
    return handle.groupBy(F.col("row_id").alias("handle_id")).agg(F.max("id").alias("contact_id"))
