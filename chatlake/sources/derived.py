"""Source tables derived from a `conversations` and a `customer` table.

The rules add what plain chat turns lack: reactions, notices, placeholders, emoji, outer
white space, bodies to decode, system and emote flags, unknown contacts, unnamed chats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatlake.sources.tables import ChatSource

_ROW_ID = "(bigint(conv_id) * 8 + turn + 1)"

# Texts by rule number; all others stay as they are. The text is a generated column, so
# that the rules which look at it do not carry this expression along.
_TEXT = r"""
    explode(array(CASE rule
        WHEN 0 THEN concat('Liked “', said, '”')
        WHEN 1 THEN concat('\ufffc ', said)
        WHEN 2 THEN NULL
        WHEN 3 THEN NULL
        WHEN 4 THEN '\ufffc'
        WHEN 5 THEN concat(said, ' \U0001f600')
        WHEN 6 THEN concat('They reacted with ', said)
        WHEN 7 THEN concat('\u00a0', said, '\u3000')
        ELSE said
    END)) AS text
"""
_BODY = """
    CASE WHEN rule IN (2, 3)
        THEN encode(concat('bplist00ZNSString$V"', said, '"'), 'UTF-8')
    END AS attributedBody
"""
# A third of the handle ids are in no contact table.
_HANDLE = """
    CASE WHEN role = 'assistant' THEN 0L
        WHEN conv % 30 < 20 THEN conv + 1
        ELSE -(conv + 1)
    END AS handle_id
"""


def derived_source(spark: SparkSession, folder: str) -> ChatSource:
    turns = spark.read.schema("conv_id long, turn long, role string, text string").parquet(
        f"{folder}/conversations.parquet"
    )
    customer = spark.read.schema("c_custkey long, c_name string").parquet(
        f"{folder}/customer.parquet"
    )
    return ChatSource(
        message=message_table(turns),
        chat=chat_table(turns),
        handle=customer.selectExpr("c_custkey + 1 AS row_id", "c_name AS id"),
        link=link_table(turns),
    )


def message_table(turns: DataFrame) -> DataFrame:
    numbered = turns.selectExpr(
        f"{_ROW_ID} AS row_id",
        "bigint(conv_id) AS conv",
        "bigint(turn) AS turn",
        "(bigint(conv_id) * 13 + turn * 7) % 20 AS rule",
        "role",
        "text AS said",
    )
    return numbered.selectExpr(
        "row_id",
        _TEXT,
        _BODY,
        "(725760000 + conv * 5400 + turn * 45) * 1000000000 AS date",
        "int(role = 'assistant') AS is_from_me",
        _HANDLE,
        "int(rule IN (1, 3, 4)) AS cache_has_attachments",
        "concat('cached', conv % 5) AS cache_roomnames",
        "CASE conv % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' END AS service",
        "int(rule = 8) AS is_emote",
        "int(role = 'system') AS is_system_message",
    )


def chat_table(turns: DataFrame) -> DataFrame:
    return turns.selectExpr("bigint(conv_id) AS conv").distinct().selectExpr(
        "conv + 1 AS row_id",
        "CASE conv % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('room', conv) END AS room_name",
        "CASE WHEN conv % 3 <> 0 THEN concat('Chat ', conv) END AS display_name",
    )


def link_table(turns: DataFrame) -> DataFrame:
    return turns.selectExpr("bigint(conv_id) + 1 AS chat_id", f"{_ROW_ID} AS message_id")


def with_second_links(source: ChatSource, every: int = 25) -> ChatSource:
    """Also link each `every`-th message to the chat half-way down, as a key violation."""
    half_way = "(chat_id + 1) div 2"
    second = source.link.filter(f"message_id % {every} = 0 AND {half_way} <> chat_id").selectExpr(
        f"{half_way} AS chat_id", "message_id"
    )
    return ChatSource(source.message, source.chat, source.handle, source.link.unionByName(second))


def run_marks(turns: DataFrame) -> DataFrame:
    """A status history: one row per conversation and stage, as if each had been a batch."""
    staged = turns.selectExpr(
        "CASE WHEN turn % 2 = 0 THEN 'extract' ELSE 'clean' END AS stage",
        "conv_id",
        f"{_ROW_ID} AS row_id",
    )
    return staged.groupBy("stage", "conv_id").agg({"row_id": "max"}).selectExpr(
        "stage",
        "`max(row_id)` AS last_id",
        "timestamp_seconds(bigint(conv_id) * 60) AS updated_at",
    )
