"""One callable `(spark, folder) -> DataFrame` per operator, on derived source tables."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatlake.functions import text as tx
from chatlake.functions.clock import clock_text
from chatlake.operators import conversations as cv
from chatlake.operators import export as ex
from chatlake.operators import pairs, profile, split, style
from chatlake.operators.clean import chat_sizes, clean
from chatlake.operators.extract import chat_lookup, extract
from chatlake.operators.keys import duplicate_ids, ids_already_stored
from chatlake.operators.runs import conversation_runs
from chatlake.plans.jobs import run_clean, run_export, run_extract, run_from_scratch, run_prepare, run_profile
from chatlake.session import delete_folder, require_checkpoint_dir, stored
from chatlake.sources.documents import KEEP_NULLS, read_documents
from chatlake.sources.derived import derived_source, run_marks, with_second_links
from chatlake.sources.store import MessageStore, decode_legacy_mark, latest_mark, latest_marks
from chatlake.sources.tables import (
    SOURCE_SCHEMAS,
    ChatSource,
    list_columns,
    list_tables,
    read_source,
    source_from_catalog,
    take_snapshot,
)
from chatlake.streaming import available_now

SEED, VAL_RATIO, MARK = 42, 0.1, 100

# Small thresholds that send the test data down the paths meant for huge groups.
HOT_ROWS, BLOCK_ROWS, PART_MESSAGES = 3, 4, 3


def _cleaned(spark: SparkSession, folder: str, **options) -> DataFrame:
    source = derived_source(spark, folder)
    return clean(extract(source), sizes=source.link, **options)


def _shown(rows: DataFrame) -> DataFrame:
    """Audit columns dropped, times as text."""
    times = [name for name, kind in rows.dtypes if kind.startswith("timestamp")]
    shown = rows.drop("processed_at", "cleaned_at")
    for name in times:
        if name in shown.columns:
            shown = shown.withColumn(name, clock_text(F.col(name)))
    return shown


def extract_messages(spark, folder):
    return _shown(extract(derived_source(spark, folder)))


def extract_after_mark(spark, folder):
    return _shown(extract(derived_source(spark, folder), after=MARK))


def decode_bodies(spark, folder):
    message = derived_source(spark, folder).message
    return message.select(
        "row_id", tx.decode_body(F.col("attributedBody")).alias("decoded")
    ).filter(F.col("decoded").isNotNull())


def resolve_texts(spark, folder):
    message = derived_source(spark, folder).message
    return message.select(
        "row_id", tx.resolve_text(F.col("text"), F.col("attributedBody")).alias("resolved")
    )


def room_name_fallback(spark, folder):
    source = derived_source(spark, folder)
    placed = source.message.join(
        source.link.withColumnRenamed("message_id", "row_id"), "row_id"
    ).select("row_id", "chat_id", "cache_roomnames")
    return chat_lookup(placed, source.chat).select(
        "row_id",
        "chat_name",
        tx.room_name(F.col("chat_room_name"), F.col("cache_roomnames")).alias("room_name"),
    )


def duplicate_key_check(spark, folder):
    return duplicate_ids(extract(with_second_links(derived_source(spark, folder))))


def stored_key_check(spark, folder):
    """Ids above the mark that are stored already, when the batch starts below it."""
    source = derived_source(spark, folder)
    known = extract(source, after=MARK)
    return ids_already_stored(extract(source), known)


def latest_mark_query(spark, folder):
    status = run_marks(spark.read.parquet(f"{folder}/conversations.parquet"))
    return latest_mark(status, F.col("stage") == "extract")


def latest_marks_query(spark, folder):
    return latest_marks(run_marks(spark.read.parquet(f"{folder}/conversations.parquet")))


def decode_legacy_marks(spark, folder):
    ids = derived_source(spark, folder).message.select("row_id")
    as_hex = F.lpad(F.hex("row_id"), 16, "0")
    pairs_of_digits = F.transform(
        F.sequence(F.lit(15), F.lit(1), F.lit(-2)), lambda at: F.substring(as_hex, at, F.lit(2))
    )
    little_endian = F.unhex(F.array_join(pairs_of_digits, ""))
    return ids.select("row_id", decode_legacy_mark(little_endian).alias("last_id"))


def clean_text_rows(spark, folder):
    message = derived_source(spark, folder).message
    return message.select("row_id", tx.clean_text(F.col("text")).alias("cleaned"))


def cleaned_messages(spark, folder):
    return _shown(_cleaned(spark, folder))


def cleaned_messages_hot_chats(spark, folder):
    return _shown(_cleaned(spark, folder, hot_rows=HOT_ROWS))


def cleaned_after_mark(spark, folder):
    return _shown(_cleaned(spark, folder, after=MARK))


def cleaned_in_two_batches(spark, folder):
    """First the opening turns of each chat, then the rest, with a continued index."""
    source = derived_source(spark, folder)
    messages = extract(source)
    opening = (F.col("message_id") - 1) % 8 < 3
    early = clean(messages.filter(opening), sizes=source.link)
    late = clean(messages.filter(~opening), earlier=chat_sizes(early), sizes=source.link)
    return _shown(early.unionByName(late))


def conversation_runs_query(spark, folder):
    runs = conversation_runs(extract(derived_source(spark, folder)))
    return _shown(runs)


def conversation_runs_blocks(spark, folder):
    """Runs in an order that mixes the chats, with the table cut into many blocks."""
    messages = extract(derived_source(spark, folder)).withColumn(
        "slot", F.col("message_id") % 16
    )
    return conversation_runs(
        messages, ("slot", "message_id"), hot_rows=HOT_ROWS, block_rows=BLOCK_ROWS
    )


def conversation_stats(spark, folder):
    return cv.conversation_stats(_cleaned(spark, folder))


def conversations(spark, folder):
    return cv.conversations(_cleaned(spark, folder)).select(
        "conversation_id", "part", F.to_json("messages").alias("messages")
    )


def training_examples(spark, folder):
    examples = cv.training_examples(_cleaned(spark, folder), style.PLAIN_PROMPT)
    return examples.select("conversation_id", cv.example_line().alias("example"))


def training_examples_in_parts(spark, folder):
    examples = cv.training_examples(
        _cleaned(spark, folder), style.PLAIN_PROMPT, part_messages=PART_MESSAGES
    )
    return examples.select("conversation_id", "part", cv.example_line().alias("example"))


def _labelled_ids(spark, folder):
    sizes = cv.conversation_sizes(_cleaned(spark, folder)).filter(F.col("message_count") >= 3)
    return split.split_once(sizes, VAL_RATIO, SEED)


def train_val_split(spark, folder):
    return _labelled_ids(spark, folder).select("conversation_id", "split")


def split_sizes(spark, folder):
    return split.split_sizes(_labelled_ids(spark, folder))


def dataset_metadata(spark, folder):
    sizes = stored(cv.conversation_sizes(_cleaned(spark, folder)))
    return split.dataset_metadata(sizes, 3, VAL_RATIO, SEED)


def export_messages(spark, folder):
    return ex.export_messages(derived_source(spark, folder)).drop("date", "linked_count")


def export_messages_hot_chats(spark, folder):
    return ex.export_messages(derived_source(spark, folder), hot_rows=HOT_ROWS).drop("date", "linked_count")


def export_conversations(spark, folder):
    source = derived_source(spark, folder)
    documents = ex.export_conversations(ex.export_messages(source), source.chat)
    return ex.by_size(documents).select(
        "id", "title", "message_count", F.to_json("messages", KEEP_NULLS).alias("messages")
    )


def export_sizes(spark, folder):
    source = derived_source(spark, folder)
    documents = ex.export_conversations(ex.export_messages(source), source.chat)
    return ex.by_size(documents).select("id", "message_count", "linked_count")


def _fresh_folder(spark) -> str:
    return f"{require_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"


def prepared_examples(spark, folder):
    """The training files as the job writes them, read back."""
    path = _fresh_folder(spark)
    run_prepare(_cleaned(spark, folder), path, val_ratio=VAL_RATIO, seed=SEED)
    kind = "id string, messages array<struct<role: string, content: string>>"
    lines = spark.read.text(f"{path}/examples").filter("trim(value) <> ''")
    example = F.from_json("value", kind)
    return lines.select(example["id"].alias("conversation_id"), "split", F.to_json(example).alias("example"))


def prepared_examples_in_parts(spark, folder):
    """The training files with conversations cut into several lines, read back."""
    path = _fresh_folder(spark)
    run_prepare(_cleaned(spark, folder), path, val_ratio=VAL_RATIO, seed=SEED, part_messages=PART_MESSAGES)
    kind = "id string, part long, messages array<struct<role: string, content: string>>"
    lines = spark.read.text(f"{path}/examples").filter("trim(value) <> ''")
    example = F.from_json("value", kind)
    return lines.select(
        example["id"].alias("conversation_id"),
        F.coalesce(example["part"], F.lit(0)).alias("part"),
        "split",
        F.to_json(example).alias("example"),
    )


def exported_documents_in_parts(spark, folder):
    """The documents cut into several lines, read back; their messages in order of the parts."""
    target = run_export(derived_source(spark, folder), _fresh_folder(spark), part_messages=PART_MESSAGES)
    documents = read_documents(spark, target.documents)
    longest = F.max(F.size("messages")).over(Window.partitionBy("id")).alias("longest_line")
    in_order = F.struct(F.coalesce("part", F.lit(0)).alias("part"), "messages")
    whole = documents.select("id", "title", "message_count", in_order.alias("line"), longest)
    return (
        whole.groupBy("id", "title", "message_count", "longest_line")
        .agg(F.count(F.lit(1)).alias("line_count"), F.array_sort(F.collect_list("line")).alias("lines"))
        .withColumn("messages", F.to_json(F.flatten(F.col("lines.messages")), KEEP_NULLS))
        .drop("lines")
    )


def exported_documents(spark, folder):
    """The documents as the job writes them, read back."""
    target = run_export(derived_source(spark, folder), _fresh_folder(spark))
    return read_documents(spark, target.documents).select(
        "id", "title", "message_count", F.to_json("messages", KEEP_NULLS).alias("messages")
    )


def _fresh_store(spark) -> MessageStore:
    store = MessageStore(spark, f"log_{uuid.uuid4().hex[:12]}", _fresh_folder(spark))
    store.create()
    return store


def _taken_from(store: MessageStore, rows: DataFrame) -> DataFrame:
    """Rows of a store that is not needed any more; its database and files go."""
    kept = stored(rows)
    store.spark.sql(f"DROP DATABASE {store.database} CASCADE")
    delete_folder(store.spark, store.location)
    return kept


def _first_half(source):
    half = source.message.selectExpr("max(row_id) div 2").first()[0] or 0
    return replace(source, message=source.message.filter(F.col("row_id") <= half))


def _stored_twice(spark, folder, index_scope="conversation") -> MessageStore:
    """A store after two rounds of extract and clean, the first of which saw half of the ids."""
    source = derived_source(spark, folder)
    store = _fresh_store(spark)
    for part in (_first_half(source), source):
        run_extract(part, store)
        run_clean(store, index_scope=index_scope)
    return store


def stored_messages_two_runs(spark, folder):
    store = _stored_twice(spark, folder)
    return _taken_from(store, _shown(store.read("extract")).drop("batch_id"))


def stored_cleaned_two_runs(spark, folder):
    store = _stored_twice(spark, folder)
    return _taken_from(store, _shown(store.read("clean")).drop("batch_id"))


def stored_cleaned_restarting(spark, folder):
    """The index as it is by default, which restarts with every batch."""
    store = _stored_twice(spark, folder, "batch")
    return _taken_from(store, _shown(store.read("clean")).drop("batch_id"))


def training_examples_two_batches(spark, folder):
    """Examples of two batches with restarting indexes: in order of index, then id."""
    store = _stored_twice(spark, folder, "batch")
    examples = cv.training_examples(store.read("clean"), style.PLAIN_PROMPT)
    return _taken_from(store, examples.select("conversation_id", cv.example_line().alias("example")))


def reply_pairs_two_batches(spark, folder):
    store = _stored_twice(spark, folder, "batch")
    found = pairs.cleaned_pairs(store.read("clean"), BLOCK_ROWS, HOT_ROWS)
    return _taken_from(store, _pairs_shown(found.withColumnRenamed("position", "message_index")))


def job_results(spark, folder):
    """What each run of the jobs reports, the marks behind them, and the audit columns filled."""
    source = derived_source(spark, folder)
    store, results = _fresh_store(spark), []

    def note(**values):
        results.extend((f"{len(results):02d} {name}", value) for name, value in values.items())

    for part in (_first_half(source), source, source):
        note(extracted=run_extract(part, store))
        note(cleaned=run_clean(store))
    note(extract_mark=store.mark("extract"))
    note(clean_mark=store.mark("clean"))
    note(processed_at=store.read("extract").filter("processed_at is not null").count())
    note(cleaned_at=store.read("clean").filter("cleaned_at is not null").count())
    store.reset()
    note(extracted_kept=store.read("extract").count())
    note(cleaned_kept=store.read("clean").count())
    scratch = run_from_scratch(source, store)
    note(extracted_anew=scratch[0])
    note(cleaned_anew=scratch[1])
    return _taken_from(store, spark.createDataFrame(results, "step string, result long"))


def imported_marks(spark, folder):
    """Marks of an older status table, taken over into a store."""
    status = run_marks(spark.read.parquet(f"{folder}/conversations.parquet"))
    store = _fresh_store(spark)
    for stage in ("extract", "clean"):
        store.import_mark(stage, status.filter(F.col("stage") == stage))
    marks = [store.progress(stage).select(F.lit(stage).alias("stage"), "last_id") for stage in ("extract", "clean")]
    return _taken_from(store, reduce(DataFrame.unionByName, marks))


def written_metadata(spark, folder):
    """The metadata file as the job writes it, read back."""
    path = _fresh_folder(spark)
    run_prepare(_cleaned(spark, folder), path, val_ratio=VAL_RATIO, seed=SEED)
    kinds = (
        "num_conversations long, num_examples long, num_training_examples long, "
        "num_validation_examples long, created_at string"
    )
    written = spark.read.schema(kinds).json(f"{path}/metadata")
    return written.filter(F.col("created_at").isNotNull()).drop("created_at")


def written_prompts(spark, folder):
    """The prompt file as the job writes it, read back."""
    target = run_export(derived_source(spark, folder), _fresh_folder(spark))
    return spark.read.schema("variant int, prompt string").json(target.prompts)


def written_conversations(spark, folder):
    """The file of whole conversations as the export writes it, read back."""
    target = run_export(derived_source(spark, folder), _fresh_folder(spark))
    kind = "id string, messages array<struct<role: string, content: string>>"
    lines = spark.read.text(target.full_conversations).filter("trim(value) <> ''")
    example = F.from_json("value", kind)
    return lines.select(example["id"].alias("id"), F.to_json(example).alias("example"))


def written_pairs(spark, folder):
    """The file of reply pairs as the export writes it, read back."""
    target = run_export(derived_source(spark, folder), _fresh_folder(spark))
    return spark.read.text(target.message_pairs).filter("trim(value) <> ''").select(F.col("value").alias("pair"))


def stored_id_order(spark, folder):
    """Stored messages, and how many of them follow a higher id in their file."""
    store = _fresh_store(spark)
    run_extract(derived_source(spark, folder), store)
    messages = spark.table(f"{store.database}.messages").select(
        "message_id", "_metadata.file_path", "_metadata.row_index"
    )
    before = F.lag("message_id").over(Window.partitionBy("file_path").orderBy("row_index"))
    counts = messages.select("message_id", before.alias("before")).agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(F.col("before") > F.col("message_id")).alias("out_of_order")
    )
    return _taken_from(store, counts)


def _parts(frame, path, *order):
    """Two files, the rows in order of the columns and one file after the other."""
    halves = frame.withColumn("half", F.ntile(2).over(Window.orderBy(*order)))
    for half in (1, 2):
        halves.filter(F.col("half") == half).drop("half").coalesce(1).write.mode("append").parquet(path)


def streamed_messages(spark, folder):
    """Messages that the stream extracted, from files in which half of the links come early and half late."""
    source, path, store = derived_source(spark, folder), _fresh_folder(spark), _fresh_store(spark)
    _parts(source.message, f"{path}/message", "row_id")
    _parts(source.link, f"{path}/chat_message_join", F.desc("message_id"))
    streams = [
        spark.readStream.schema(SOURCE_SCHEMAS[name]).option("maxFilesPerTrigger", 1).parquet(f"{path}/{name}")
        for name in ("message", "chat_message_join")
    ]
    query = available_now.start(*streams, lambda: derived_source(spark, folder), store, f"{path}/checkpoint")
    query.awaitTermination()
    return _taken_from(store, _shown(store.read("extract")).drop("batch_id"))


def full_conversations(spark, folder):
    source = derived_source(spark, folder)
    documents = ex.export_conversations(ex.export_messages(source), source.chat)
    whole = ex.full_conversations(documents, style.PLAIN_PROMPT)
    return whole.select("id", cv.example_line("id").alias("example"))


def normalize_roles(spark, folder):
    source = derived_source(spark, folder)
    documents = ex.export_conversations(ex.export_messages(source), source.chat)
    return cv.normalize_roles(documents).select("id", F.to_json("messages").alias("messages"))


def _pairs_shown(found):
    return found.select("chat_id", "message_index", pairs.pair_line(style.PLAIN_PROMPT).alias("pair"))


def reply_pairs(spark, folder):
    return _pairs_shown(pairs.reply_pairs(ex.export_messages(derived_source(spark, folder))))


def reply_pairs_blocks(spark, folder):
    rows = ex.export_messages(derived_source(spark, folder), hot_rows=HOT_ROWS)
    return _pairs_shown(pairs.reply_pairs(rows, block_rows=BLOCK_ROWS))


def reply_pairs_cleaned(spark, folder):
    """Pairs on the incremental path, where every cleaned message counts."""
    rows = _cleaned(spark, folder).withColumn("role", tx.party_role(F.col("is_from_me")))
    return _pairs_shown(pairs.reply_pairs(rows.withColumnRenamed("text", "content")))


def style_stats(spark, folder):
    stats = style.style_stats(ex.export_messages(derived_source(spark, folder)))
    return stats.select(
        "own_messages",
        F.round("mean_length", 6).alias("mean_length"),
        F.round("emojis_per_message", 6).alias("emojis_per_message"),
    )


def prompt(spark, folder):
    stats = style.style_stats(ex.export_messages(derived_source(spark, folder)))
    return style.render_prompt(stats)


def prompt_variants(spark, folder):
    return style.prompt_variants(prompt(spark, folder))


def length_stats(spark, folder):
    stats = profile.length_stats(derived_source(spark, folder))
    return stats.withColumn("avg_length", F.round("avg_length", 6))


def length_histogram(spark, folder):
    histogram = profile.length_histogram(derived_source(spark, folder))
    return histogram.withColumn("lower_edge", F.round("lower_edge", 6))


def profile_in_one_scan(spark, folder):
    """All reports of a profile run as rows, lengths rounded as in the single reports."""
    found = run_profile(derived_source(spark, folder))
    found["length_stats"] = found["length_stats"].withColumn("avg_length", F.round("avg_length", 6))
    found["length_histogram"] = found["length_histogram"].withColumn("lower_edge", F.round("lower_edge", 6))
    values = {
        name: frame.select(F.lit(name).alias("report"), *_as_text(frame)) for name, frame in found.items()
    }
    return reduce(DataFrame.unionAll, values.values())


def _as_text(frame):
    """Up to four columns as text; missing ones are null."""
    names = [*frame.columns, *[None] * (4 - len(frame.columns))]
    return [
        (F.col(name).cast("string") if name else F.lit(None).cast("string")).alias(f"value_{at}")
        for at, name in enumerate(names, 1)
    ]


def _written_source(spark, folder, source) -> str:
    path = _fresh_folder(spark)
    _append_source(source, path)
    return path


def _append_source(source, path) -> None:
    tables = {"message": source.message, "chat": source.chat, "handle": source.handle, "chat_message_join": source.link}
    for name, frame in tables.items():
        frame.write.mode("append").parquet(f"{path}/{name}")


def _later(source):
    """The same rows once more under higher ids, as if written later, linked to the same chats and to new ones."""
    highest = take_snapshot(source)
    up = {name: max(getattr(highest, name), 0) for name in ("message", "chat", "handle")}
    message = source.message.withColumn("row_id", F.col("row_id") + up["message"])
    chat = source.chat.withColumn("row_id", F.col("row_id") + up["chat"])
    handle = source.handle.withColumn("row_id", F.col("row_id") + up["handle"])
    moved = source.link.withColumn("message_id", F.col("message_id") + up["message"])
    new_chats = moved.withColumn("chat_id", F.col("chat_id") + up["chat"])
    return ChatSource(message, chat, handle, moved.unionByName(new_chats))


def snapshot_read(spark, folder):
    """Messages extracted from files, of which more were written once the snapshot had been taken."""
    source = derived_source(spark, folder)
    path = _written_source(spark, folder, source)
    snapshot = take_snapshot(read_source(spark, path))
    _append_source(_later(source), path)
    return _shown(extract(read_source(spark, path, snapshot=snapshot)))


def source_tables(spark, folder):
    """Names, columns and types of source tables in the catalog, and rows read from there."""
    source, database = derived_source(spark, folder), f"source_{uuid.uuid4().hex[:12]}"
    path = _written_source(spark, folder, source)
    spark.sql(f"CREATE DATABASE {database}")
    try:
        for name in SOURCE_SCHEMAS:
            spark.catalog.createTable(f"{database}.{name}", f"{path}/{name}", "parquet")
        known = source_from_catalog(spark, database)
        sizes = {"message": known.message, "chat": known.chat, "handle": known.handle, "chat_message_join": known.link}
        sizes = [frame.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name)) for name, frame in sizes.items()]
        columns = [
            list_columns(spark, f"{database}.{row.table_name}").withColumn("table_name", F.lit(row.table_name))
            for row in list_tables(spark, database).collect()
        ]
        listed = reduce(DataFrame.unionAll, columns)
        return stored(listed.join(reduce(DataFrame.unionByName, sizes), "table_name"))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def _report(function):
    return lambda spark, folder: function(derived_source(spark, folder))


QUERIES = {
    "extract_messages": extract_messages,
    "extract_after_mark": extract_after_mark,
    "decode_bodies": decode_bodies,
    "resolve_texts": resolve_texts,
    "room_name_fallback": room_name_fallback,
    "duplicate_key_check": duplicate_key_check,
    "stored_key_check": stored_key_check,
    "latest_mark": latest_mark_query,
    "latest_marks": latest_marks_query,
    "decode_legacy_marks": decode_legacy_marks,
    "clean_text_rows": clean_text_rows,
    "cleaned_messages": cleaned_messages,
    "cleaned_messages_hot_chats": cleaned_messages_hot_chats,
    "cleaned_after_mark": cleaned_after_mark,
    "cleaned_in_two_batches": cleaned_in_two_batches,
    "conversation_runs": conversation_runs_query,
    "conversation_runs_blocks": conversation_runs_blocks,
    "conversation_stats": conversation_stats,
    "conversations": conversations,
    "training_examples": training_examples,
    "training_examples_in_parts": training_examples_in_parts,
    "train_val_split": train_val_split,
    "split_sizes": split_sizes,
    "dataset_metadata": dataset_metadata,
    "export_messages": export_messages,
    "export_messages_hot_chats": export_messages_hot_chats,
    "export_conversations": export_conversations,
    "export_sizes": export_sizes,
    "prepared_examples": prepared_examples,
    "prepared_examples_in_parts": prepared_examples_in_parts,
    "exported_documents": exported_documents,
    "exported_documents_in_parts": exported_documents_in_parts,
    "stored_messages_two_runs": stored_messages_two_runs,
    "stored_cleaned_two_runs": stored_cleaned_two_runs,
    "stored_cleaned_restarting": stored_cleaned_restarting,
    "training_examples_two_batches": training_examples_two_batches,
    "reply_pairs_two_batches": reply_pairs_two_batches,
    "job_results": job_results,
    "imported_marks": imported_marks,
    "written_metadata": written_metadata,
    "written_prompts": written_prompts,
    "full_conversations": full_conversations,
    "normalize_roles": normalize_roles,
    "reply_pairs": reply_pairs,
    "reply_pairs_blocks": reply_pairs_blocks,
    "reply_pairs_cleaned": reply_pairs_cleaned,
    "style_stats": style_stats,
    "prompt": prompt,
    "prompt_variants": prompt_variants,
    "basic_counts": _report(profile.basic_counts),
    "by_service": _report(profile.count_by_service),
    "time_range": _report(profile.time_range),
    "length_stats": length_stats,
    "by_month": _report(profile.messages_by_month),
    "by_hour": _report(profile.messages_by_hour),
    "top_senders": _report(profile.top_senders),
    "top_conversations": _report(profile.top_conversations),
    "oldest_conversation": _report(profile.oldest_conversation),
    "recent_messages": _report(profile.recent_messages),
    "length_histogram": length_histogram,
    "profile_in_one_scan": profile_in_one_scan,
    "snapshot_read": snapshot_read,
    "source_tables": source_tables,
    "written_conversations": written_conversations,
    "written_pairs": written_pairs,
    "stored_id_order": stored_id_order,
    "streamed_messages": streamed_messages,
}
