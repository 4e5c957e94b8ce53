"""Extract and clean as one Structured Streaming job over new message and link files.

Messages and links are two streams that are joined with keyed state: whichever of a message and its
link comes first waits in the state store for the other. How long is bounded by `wait`, in times of
arrival; a message whose link has not come by then leaves the state and is stored as unlinked, so
state holds what arrived within about twice that time and nothing is lost unseen.

The checkpoint takes the place of the progress mark: each file is read once, so late rows
with low ids are picked up, which the mark would skip. Every micro-batch becomes one committed batch of
the store, under the stream's batch number; a batch that is replayed after a failure replaces itself.
Use a store for the stream or for the batch jobs, not both.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatlake import schemas
from chatlake.operators.clean import clean
from chatlake.operators.extract import considered, extract
from chatlake.operators.numbering import HOT_ROWS
from chatlake.session import delete_folder, require_checkpoint_dir
from chatlake.sources.store import CLEAN, EXTRACT, MessageStore
from chatlake.sources.tables import ChatSource

#: How long a message and its link wait for each other.
WAIT = "1 day"
#: When a row arrived, for streams of files.
ARRIVED = "_metadata.file_modification_time"


def linked_messages(
    messages: DataFrame, links: DataFrame, wait: str = WAIT, arrived: str = ARRIVED
) -> DataFrame:
    """Messages with the `chat_id` of their link, null once `wait` has passed without one.

    Both are streams with a time `arrived`; rows may be out of order by up to `wait`. Messages without
    content, system messages and emotes do not take part, so no state is kept for them.
    """
    message = considered(messages.select("*", F.col(arrived).alias("arrived")))
    link = links.select("chat_id", "message_id", F.col(arrived).alias("link_arrived"))
    near = F.expr(f"link_arrived BETWEEN arrived - INTERVAL '{wait}' AND arrived + INTERVAL '{wait}'")
    return message.withWatermark("arrived", wait).join(
        link.withWatermark("link_arrived", wait), (F.col("row_id") == F.col("message_id")) & near, "left_outer"
    )


def process_batch(
    rows: DataFrame,
    batch_id: int,
    tables: Callable[[], ChatSource],
    store: MessageStore,
    hot_rows: int = HOT_ROWS,
) -> None:
    """Extract and clean one micro-batch of `linked_messages`; the index goes on behind the stored rows.

    Links to chats that are not listed yet are kept in the store and tried again with the next batch.
    """
    spark = rows.sparkSession
    store = store.on(spark)
    # Stored, because state must be read and written once in a micro-batch.
    path = f"{require_checkpoint_dir(spark)}/micro-batch-{uuid.uuid4().hex}"
    rows.select(*schemas.WAITING.fieldNames()).write.parquet(path)
    kept = spark.read.schema(schemas.WAITING).parquet(path)
    linked = kept.filter(F.col("chat_id").isNotNull()).unionByName(store.waiting_before(batch_id))
    if linked.isEmpty() and kept.isEmpty():  # nothing came, and nothing waits for its chat
        delete_folder(spark, path)
        return
    links = linked.select("chat_id", F.col("row_id").alias("message_id"))
    source = replace(tables(), message=linked.drop("chat_id"), link=links)
    attempt = store.write_batch(EXTRACT, extract(source), batch_id)
    extracted = store.read_batch(EXTRACT, batch_id, attempt)
    _commit(store, EXTRACT, batch_id, attempt)
    cleaned = clean(extracted, earlier=store.sizes_before(batch_id), hot_rows=hot_rows)
    _commit(store, CLEAN, batch_id, store.write_batch(CLEAN, cleaned, batch_id))
    listed = source.chat.select(F.col("row_id").alias("chat_id"))
    store.replace_waiting(linked.join(listed, "chat_id", "left_anti"), batch_id)
    store.add_unlinked(kept.filter(F.col("chat_id").isNull()).drop("chat_id"), batch_id)
    delete_folder(spark, path)


def _commit(store: MessageStore, stage: str, batch_id: int, attempt: str) -> None:
    row_count, last_id = store.batch_summary(stage, batch_id, attempt)
    if row_count == 0:
        store.drop_attempt(stage, batch_id, attempt)
    else:
        store.commit(stage, batch_id, attempt, last_id, row_count)


def reset(store: MessageStore, checkpoint: str) -> None:
    """Forget all rows and what the stream has read, so that the next start reads everything."""
    store.reset(include_raw=True)
    delete_folder(store.spark, checkpoint)


def start(
    messages: DataFrame,
    links: DataFrame,
    tables: Callable[[], ChatSource],
    store: MessageStore,
    checkpoint: str,
    wait: str = WAIT,
    arrived: str = ARRIVED,
    hot_rows: int = HOT_ROWS,
) -> StreamingQuery:
    """Process all new rows of the `messages` and `links` streams, then stop.

    `tables` is called for every micro-batch, so that it sees chats and contacts that arrived with the
    messages; its messages and links are not read.
    """
    return (
        linked_messages(messages, links, wait, arrived)
        .writeStream.foreachBatch(
            lambda batch, number: process_batch(batch, number, tables, store, hot_rows)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows of a run that came later than `wait` behind newer ones, and were not joined."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
