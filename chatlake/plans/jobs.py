"""The jobs: incremental extract and clean, prepare, export."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chatlake.functions import text as tx
from chatlake.operators import conversations as cv
from chatlake.operators import export as ex
from chatlake.operators import pairs, profile, split, style
from chatlake.operators.clean import clean
from chatlake.operators.extract import candidates
from chatlake.operators.numbering import HOT_ROWS, number_rows
from chatlake.session import stored
from chatlake.sources import documents as docs
from chatlake.sources.store import CLEAN, EXTRACT, MessageStore
from chatlake.sources.tables import ChatSource, take_snapshot

IndexScope = Literal["batch", "conversation"]


def run_extract(source: ChatSource, store: MessageStore) -> int:
    """Extract messages above the mark; returns the number of rows stored.

    The new mark is the highest id before the text rules. It is observed while the batch is
    written; a repeated task cannot change a maximum. All tables are read as of the start of the run.
    """
    mark = store.mark(EXTRACT)
    source = take_snapshot(source).of(source)
    seen = Observation()
    considered = candidates(source, after=mark).observe(seen, F.max("message_id").alias("last_id"))
    rows = considered.filter(F.col("text").isNotNull())
    attempt = store.write_batch(EXTRACT, rows, mark)
    row_count, _ = store.batch_summary(EXTRACT, mark, attempt)
    if row_count == 0:
        store.drop_attempt(EXTRACT, mark, attempt)
        return 0
    store.commit(EXTRACT, mark, attempt, seen.get["last_id"], row_count)
    return row_count


def run_clean(
    store: MessageStore, index_scope: IndexScope = "batch", hot_rows: int = HOT_ROWS
) -> int:
    """Clean extracted messages above the mark; returns the number of rows stored."""
    mark = store.mark(CLEAN)
    earlier = store.sizes_before(mark) if index_scope == "conversation" else None
    rows = clean(store.read(EXTRACT, after=mark), after=mark, earlier=earlier, hot_rows=hot_rows)
    attempt = store.write_batch(CLEAN, rows, mark)
    row_count, last_id = store.batch_summary(CLEAN, mark, attempt)
    if row_count == 0:
        store.drop_attempt(CLEAN, mark, attempt)
        return 0
    store.commit(CLEAN, mark, attempt, last_id, row_count)
    return row_count


def run_from_scratch(source: ChatSource, store: MessageStore) -> tuple[int, int]:
    """Reset the store, then extract and clean everything."""
    store.reset(include_raw=True)
    return run_extract(source, store), run_clean(store)


def run_prepare(
    cleaned: DataFrame,
    path: str,
    prompt: Column | str = style.PLAIN_PROMPT,
    min_messages: int = 3,
    val_ratio: float = 0.1,
    seed: int = 42,
    hot_rows: int = HOT_ROWS,
    part_messages: int | None = HOT_ROWS,
) -> None:
    """Write one JSON line per example and split, and metadata, below `path`.

    Sizes are stored once: the split and the metadata both read them. `part_messages` is as in
    `write_conversations`.
    """
    sizes = stored(cv.conversation_sizes(cleaned))
    eligible = sizes.filter(F.col("message_count") >= min_messages)
    rows = number_rows(
        cleaned, "chat_id", ("message_index", "message_id"), total="total", hot_rows=hot_rows
    ).filter(F.col("total") >= min_messages)
    docs.write_conversations(
        split.assign_split(rows, eligible, val_ratio, seed),
        head=F.struct(F.col("conversation_id").alias("id")),
        message=cv.chat_message(tx.chat_role(F.col("is_from_me")), F.col("text")),
        path=f"{path}/examples",
        order=[],
        lead=cv.chat_message("system", prompt),
        partition="split",
        part_messages=part_messages,
    )
    metadata = split.dataset_metadata(sizes, min_messages, val_ratio, seed)
    docs.write_metadata(
        metadata.withColumn("created_at", F.current_timestamp()), f"{path}/metadata"
    )


def run_profile(source: ChatSource) -> dict[str, DataFrame]:
    """All reports, as of the start of the run.

    Messages are read once, for the facts behind seven reports, and links once. The two reports on single
    messages read the few columns they order by.
    """
    source = take_snapshot(source).of(source)
    found = profile.reports(source, stored(profile.message_facts(source)), stored(profile.link_facts(source)))
    return found | {
        "oldest_conversation": profile.oldest_conversation(source),
        "recent_messages": profile.recent_messages(source),
    }


@dataclass(frozen=True)
class Export:
    """Where a full export lies, below one folder."""

    path: str

    @property
    def messages(self) -> str:
        return f"{self.path}/messages"

    @property
    def documents(self) -> str:
        return f"{self.path}/documents"

    @property
    def full_conversations(self) -> str:
        return f"{self.path}/full_conversations"

    @property
    def message_pairs(self) -> str:
        return f"{self.path}/message_pairs"

    @property
    def prompts(self) -> str:
        return f"{self.path}/prompts"


def run_export(
    source: ChatSource,
    path: str,
    min_linked: int = 4,
    min_clean: int = 5,
    self_role: str = "self",
    template: str = style.STYLE_TEMPLATE,
    hot_rows: int = HOT_ROWS,
    part_messages: int | None = HOT_ROWS,
) -> Export:
    """Write documents, whole conversations, reply pairs and prompts below `path`.

    The flat rows are written first: four outputs read them, and joining and numbering them
    once costs less than doing it for each. All tables are read as of the start of the run.
    `part_messages` is as in `write_conversations`.
    """
    source = take_snapshot(source).of(source)
    spark = source.message.sparkSession
    target = Export(path)
    ex.export_messages(source, min_linked, min_clean, self_role, hot_rows).write.mode(
        "overwrite"
    ).parquet(target.messages)
    rows = spark.read.parquet(target.messages)
    placed = rows.withColumnsRenamed({"message_index": "position", "message_count": "total"})
    largest_first = [F.desc("linked_count")]
    titles = source.chat.select(
        F.col("row_id").alias("chat_id"),
        tx.chat_title(F.col("display_name"), F.col("row_id")).alias("title"),
    )
    name = tx.conversation_id(F.col("chat_id"), "conversation_").alias("id")
    docs.write_conversations(
        placed.join(titles, "chat_id"),
        head=F.struct(name, "title", F.col("total").alias("message_count")),
        message=F.struct("role", "content", "timestamp", "contact_id", "has_media"),
        path=target.documents,
        order=largest_first,
        part_messages=part_messages,
    )

    rendered = style.render_prompt(style.style_stats(rows, self_role), template)
    docs.write_prompts(style.prompt_variants(rendered), target.prompts)
    prompt = style.prompt_column(
        spark.read.schema("variant int, prompt string").json(target.prompts).filter("variant = 0")
    )
    docs.write_conversations(
        placed,
        head=F.struct(name),
        message=cv.chat_message(ex.example_role(F.col("role")), F.col("content")),
        path=target.full_conversations,
        order=largest_first,
        lead=cv.chat_message("system", prompt),
        part_messages=part_messages,
    )
    replies = pairs.reply_pairs(rows, self_role=self_role)
    docs.write_lines(replies, pairs.pair_line(prompt), target.message_pairs)
    return target
