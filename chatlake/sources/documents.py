"""JSON and JSON-lines readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake import schemas
from chatlake.functions.clock import integer_div
from chatlake.operators.numbering import HOT_ROWS

#: Nulls are written, so that every message of a document has all its keys.
KEEP_NULLS = {"ignoreNullFields": "false"}


def write_lines(rows: DataFrame, line: Column, path: str, partition: str | None = None) -> None:
    """One JSON object per line; with `partition`, one folder per value of that column."""
    columns = [line.alias("value")]
    if partition:
        rows.select(partition, *columns).write.mode("overwrite").partitionBy(partition).text(path)
    else:
        rows.select(*columns).write.mode("overwrite").text(path)


def write_documents(documents: DataFrame, path: str) -> None:
    """Documents that are rows already; `part` is written only if they are cut into parts."""
    columns = ["id", "title", "messages", "message_count"]
    if "part" in documents.columns:
        columns.append("part")
    documents.select(*columns).write.mode("overwrite").json(path, ignoreNullFields=False)


def write_conversations(
    messages: DataFrame,
    head: Column,
    message: Column,
    path: str,
    order: Sequence[Column | str],
    lead: Column | None = None,
    partition: str | None = None,
    part_messages: int | None = HOT_ROWS,
) -> None:
    """One JSON line per conversation, without ever holding one in memory.

    `messages` has `chat_id`, a dense `position` from 0 and the `total` of each conversation. A line is
    written in fragments: the first message brings the struct `head` and the message `lead`, the last
    one closes the line. With an
    `order`, files in order of name are in that order too. Each file starts with an empty line, which JSON
    readers pass over.

    A conversation of more than `part_messages` is several lines, each written by one task: lines after the
    first have no `lead` and say in `part` which they are, and their messages in order of `part` are the
    conversation. With None it is one line of any length, and one task sorts it.
    """
    if part_messages is None:
        part, is_first = F.lit(0), F.col("position") == 0
        is_last = F.col("position") == F.col("total") - 1
    else:
        part, is_first = integer_div(F.col("position"), part_messages), F.col("position") % part_messages == 0
        is_last = (F.col("position") == F.col("total") - 1) | ((F.col("position") + 1) % part_messages == 0)
    opening = F.regexp_replace(F.to_json(head, KEEP_NULLS), r"\}\z", "")
    first_lead = F.lit("") if lead is None else F.concat(F.to_json(lead, KEEP_NULLS), F.lit(","))
    start = F.when(F.col("position") == 0, F.concat(F.lit(',"messages":['), first_lead)).otherwise(
        F.concat(F.lit(',"part":'), part, F.lit(',"messages":['))
    )
    before = F.when(is_first, F.concat(F.lit("\n"), opening, start)).otherwise(",")
    after = F.when(is_last, "]}").otherwise("")
    fragment = F.concat(before, F.to_json(message, KEEP_NULLS), after).alias("value")
    line = [*order, F.col("chat_id"), part]
    dealt = messages.repartitionByRange(*line) if order else messages.repartition(*line)
    kept = [partition] if partition else []
    ordered = dealt.sortWithinPartitions(*kept, *order, "chat_id", "position")
    # A line must not be cut between files, whatever the session says.
    options = {"lineSep": " ", "maxRecordsPerFile": "0"}
    writer = ordered.select(*kept, fragment).write.mode("overwrite").options(**options)
    (writer.partitionBy(partition) if partition else writer).text(path)


def read_documents(spark: SparkSession, path: str, one_array: bool = False) -> DataFrame:
    """Conversation documents from JSON lines, or from files that hold one array each.

    A file with one array cannot be cut, so it is parsed by one task: lines are the format
    for large data.
    """
    return spark.read.schema(schemas.DOCUMENT).json(path, multiLine=one_array)


def write_prompts(variants: DataFrame, path: str) -> None:
    variants.write.mode("overwrite").json(path)


def write_metadata(metadata: DataFrame, path: str) -> None:
    metadata.write.mode("overwrite").json(path)
