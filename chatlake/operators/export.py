"""Full export: rich conversation documents straight from the source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.functions import text as tx
from chatlake.functions.clock import clock_text, source_timestamp
from chatlake.operators.clean import keep_clean
from chatlake.operators.conversations import (
    assemble,
    chat_message,
    lead_with_system,
)
from chatlake.operators.extract import with_contact
from chatlake.operators.numbering import HOT_ROWS, number_rows
from chatlake.operators.profile import links_per_chat
from chatlake.sources.tables import ChatSource


def export_messages(
    source: ChatSource,
    min_linked: int = 4,
    min_clean: int = 5,
    self_role: str = "self",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Flat export rows with index, message count and linked count of their conversation.

    Chats need `min_linked` linked messages of any kind and `min_clean` that survive the
    text rules. Only `text` counts here: bodies, system and emote flags are not looked at.
    """
    message = keep_clean(source.message, cleaned="content").select(
        F.col("row_id").alias("message_id"),
        "date",
        tx.party_role(F.col("is_from_me"), self_role).alias("role"),
        "content",
        tx.has_placeholder(F.col("text")).alias("has_media"),
        "is_from_me",
        "handle_id",
    )
    linked = links_per_chat(source).filter(F.col("message_count") >= min_linked)
    linked = linked.select("chat_id", F.col("message_count").alias("linked_count"))
    links = source.link.join(linked, "chat_id")
    rows = with_contact(message.join(links, "message_id"), source).select(
        "chat_id",
        "linked_count",
        "message_id",
        "date",
        "role",
        "content",
        clock_text(source_timestamp(F.col("date"))).alias("timestamp"),
        tx.party_contact(F.col("is_from_me"), F.col("contact_id")).alias("contact_id"),
        "has_media",
    )
    numbered = number_rows(
        rows,
        "chat_id",
        ("date", "message_id"),
        position="message_index",
        total="message_count",
        sizes=source.link,
        hot_rows=hot_rows,
    )
    return numbered.filter(F.col("message_count") >= min_clean)


def export_conversations(
    rows: DataFrame, chat: DataFrame, part_messages: int | None = None
) -> DataFrame:
    """Documents `id, title, messages, message_count` with `chat_id` and `part`.

    Titles are joined to the documents, not to the messages.
    """
    documents = assemble(
        rows,
        ["chat_id", "message_count", "linked_count"],
        "message_index",
        "message_id",
        ["role", "content", "timestamp", "contact_id", "has_media"],
        part_messages,
    )
    titles = chat.select(
        F.col("row_id").alias("chat_id"),
        tx.chat_title(F.col("display_name"), F.col("row_id")).alias("title"),
    )
    return documents.join(titles, "chat_id").select(
        "chat_id",
        "part",
        tx.conversation_id(F.col("chat_id"), "conversation_").alias("id"),
        "title",
        "messages",
        "message_count",
        "linked_count",
    )


def by_size(documents: DataFrame) -> DataFrame:
    """Documents in order of the messages linked to their chat, most first."""
    return documents.orderBy(F.desc("linked_count"), "chat_id", "part")


def example_role(role: Column) -> Column:
    return F.when(role == "friend", F.lit("user")).otherwise(F.lit("assistant"))


def full_conversations(documents: DataFrame, prompt: Column | str) -> DataFrame:
    """Whole conversations as examples: system prompt, then user and assistant messages."""

    def relabelled(message: Column) -> Column:
        return chat_message(example_role(message["role"]), message["content"])

    messages = F.transform("messages", relabelled)
    return documents.select(
        "id", "part", lead_with_system(messages, F.col("part"), prompt).alias("messages")
    )
