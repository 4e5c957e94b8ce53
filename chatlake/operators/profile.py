"""Descriptive reports over the unfiltered source tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatlake.functions import text as tx
from chatlake.functions.clock import clock_text, hour_text, month_text, source_timestamp
from chatlake.operators.extract import contact_ids
from chatlake.sources.tables import ChatSource

UNNAMED = "Unnamed Chat"
#: Texts longer than this are left out of the histogram, so there are no more lengths to count.
LONGEST = 999


def basic_counts(source: ChatSource) -> DataFrame:
    """`label, n` for messages, chats, contacts, attachments and empty texts."""
    text = F.col("text")
    counted = source.message.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("cache_has_attachments") == 1).alias("media"),
        F.count_if(text.isNull() | (text == "")).alias("empty"),
    ).select(
        F.stack(
            F.lit(3),
            F.lit("Total messages"),
            F.col("total"),
            F.lit("Messages with attachments"),
            F.col("media"),
            F.lit("Empty messages"),
            F.col("empty"),
        ).alias("label", "n")
    )
    chats = source.chat.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("Total conversations").alias("label"), "n"
    )
    contacts = source.handle.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("Total contacts").alias("label"), "n"
    )
    return counted.unionByName(chats).unionByName(contacts)


def count_by_service(source: ChatSource) -> DataFrame:
    """Messages per service; null and empty services stay apart, both named Unknown."""
    counted = source.message.groupBy("service").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(tx.label_or(F.col("service"), F.lit("Unknown")).alias("service"), "n")


def time_range(source: ChatSource) -> DataFrame:
    dated = source.message.filter(F.col("date") > 0)
    return dated.agg(F.min("date").alias("first"), F.max("date").alias("last")).select(
        clock_text(source_timestamp(F.col("first"))).alias("first_message"),
        clock_text(source_timestamp(F.col("last"))).alias("last_message"),
    )


def length_stats(source: ChatSource) -> DataFrame:
    length = F.length("text")
    return source.message.filter(length > 0).agg(
        F.avg(length).alias("avg_length"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
        F.count(F.lit(1)).alias("count_with_text"),
    )


def _count_by_time(source: ChatSource, name: str, label: Column) -> DataFrame:
    dated = source.message.filter(F.col("date") > 0).select(label.alias(name))
    return dated.groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(name)


def messages_by_month(source: ChatSource) -> DataFrame:
    return _count_by_time(source, "month", month_text(source_timestamp(F.col("date"))))


def messages_by_hour(source: ChatSource) -> DataFrame:
    return _count_by_time(source, "hour", hour_text(source_timestamp(F.col("date"))))


def top_senders(source: ChatSource, k: int = 10) -> DataFrame:
    """Most frequent senders. Messages are counted per contact id before the join."""
    by_handle = source.message.groupBy(
        "handle_id", (F.col("is_from_me") == 1).cast("int").alias("is_from_me")
    ).agg(F.count(F.lit(1)).alias("n"))
    return _top_senders(by_handle, source.handle, k)


def _top_senders(by_handle: DataFrame, handle: DataFrame, k: int) -> DataFrame:
    sender = tx.sender_label(F.col("is_from_me"), F.col("contact_id"))
    return (
        by_handle.join(contact_ids(handle), "handle_id", "left")
        .groupBy(sender.alias("sender"))
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "sender")
        .limit(k)
    )


def links_per_chat(source: ChatSource) -> DataFrame:
    """`chat_id, display_name, message_count`, counted before the join with chats."""
    return _named(link_facts(source), source.chat)


def _named(counted: DataFrame, chat: DataFrame) -> DataFrame:
    return counted.join(chat.select(F.col("row_id").alias("chat_id"), "display_name"), "chat_id")


def _title() -> Column:
    return tx.label_or(F.col("display_name"), F.lit(UNNAMED)).alias("title")


def top_conversations(source: ChatSource, k: int = 10) -> DataFrame:
    return _top_conversations(link_facts(source), source.chat, k)


def _top_conversations(links: DataFrame, chat: DataFrame, k: int) -> DataFrame:
    return (
        _named(links, chat)
        .orderBy(F.desc("message_count"), "chat_id")
        .limit(k)
        .select("chat_id", _title(), "message_count")
    )


def oldest_conversation(source: ChatSource) -> DataFrame:
    """The chat with the earliest first message, undated ones first, by whole seconds."""
    dates = source.message.select(F.col("row_id").alias("message_id"), "date")
    per_chat = (
        source.link.join(dates, "message_id")
        .groupBy("chat_id")
        .agg(F.min("date").alias("first_date"), F.count(F.lit(1)).alias("message_count"))
    )
    names = source.chat.select(F.col("row_id").alias("chat_id"), "display_name")
    return (
        per_chat.join(names, "chat_id")
        .withColumn("first_message", clock_text(source_timestamp(F.col("first_date"))))
        .orderBy(F.asc_nulls_first("first_message"), "chat_id")
        .limit(1)
        .select("chat_id", _title(), "first_message", "message_count")
    )


def recent_messages(source: ChatSource, k: int = 5) -> DataFrame:
    """The latest messages with text; contacts are joined to these only."""
    latest = (
        source.message.filter(F.col("text").isNotNull())
        .select("row_id", "date", "is_from_me", "handle_id", "text")
        .orderBy(F.desc_nulls_last("date"), F.desc("row_id"))
        .limit(k)
    )
    return latest.join(contact_ids(source.handle), "handle_id", "left").select(
        F.col("row_id").alias("message_id"),
        clock_text(source_timestamp(F.col("date"))).alias("sent_at"),
        tx.sender_label(F.col("is_from_me"), F.col("contact_id")).alias("sender"),
        tx.preview(F.col("text")).alias("text_sample"),
    )


def length_histogram(source: ChatSource, bins: int = 30, longest: int = LONGEST) -> DataFrame:
    """Texts of 1 to `longest` characters in equal-width bins; empty bins are listed.

    Lengths are counted first: bounds and bins follow from at most `longest` counts, so the
    texts are read once.
    """
    lengths = source.message.select(F.length("text").alias("length")).filter(F.col("length").between(1, longest))
    return _histogram(lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n")), bins)


def _histogram(counts: DataFrame, bins: int = 30) -> DataFrame:
    """Bins of `length, n`, each length once."""
    all_counts = Window.partitionBy()
    low, high = F.min("length").over(all_counts), F.max("length").over(all_counts)
    placed = counts.select("length", "n", low.alias("low"), (high - low).alias("width"))
    step = F.floor((F.col("length") - F.col("low")) / F.col("width") * bins)
    number = F.when(F.col("width") == 0, F.lit(0)).otherwise(F.least(step, F.lit(bins - 1)))
    totals = placed.groupBy(number.cast("long").alias("bin")).agg(
        F.sum("n").alias("n"), F.first("low").alias("low"), F.first("width").alias("width")
    )
    # One row that holds all bins that have rows, beside which the empty ones are listed.
    found = totals.agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("n"),
        F.max("low").alias("low"),
        F.max("width").alias("width"),
    )
    listed = found.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1)).cast("array<bigint>")).alias("bin"), "*")
    return listed.select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("width") / bins).alias("lower_edge"),
        F.coalesce(F.try_element_at("n", F.col("bin")), F.lit(0)).alias("n"),
    ).orderBy("bin")


# --- All reports at once ---

_KEYS = ["service", "month", "hour", "length", "handle_id", "is_from_me"]
_SETS = {
    "all": [],
    "service": ["service"],
    "month": ["month"],
    "hour": ["hour"],
    "length": ["length"],
    "sender": ["handle_id", "is_from_me"],
}


def message_facts(source: ChatSource, longest: int = LONGEST) -> DataFrame:
    """What the reports need of the messages, from one scan: an aggregate over grouping sets.

    `fact` names the set. There is a row for each service, month, hour, length up to `longest` and
    contact, and one for all messages; only lengths of texts are read, and sums are combined
    before the shuffle.
    """
    dated, length = F.col("date") > 0, F.length("text")
    sent = source_timestamp(F.col("date"))
    rows = source.message.select(
        "service",
        F.when(dated, month_text(sent)).alias("month"),
        F.when(dated, hour_text(sent)).alias("hour"),
        F.when(length.between(1, longest), length).alias("length"),
        "handle_id",
        (F.col("is_from_me") == 1).cast("int").alias("is_from_me"),
        F.when(dated, F.col("date")).alias("date"),
        (F.col("cache_has_attachments") == 1).alias("media"),
        (F.col("text").isNull() | (F.col("text") == "")).alias("empty"),
        F.when(length > 0, length).alias("text_length"),
    )
    sets = [[F.col(name) for name in names] for names in _SETS.values()]
    grouped = rows.groupingSets(sets, *_KEYS).agg(
        F.grouping_id().alias("_id"),
        F.count(F.lit(1)).alias("n"),
        F.count_if("media").alias("media"),
        F.count_if("empty").alias("empty"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.sum("text_length").alias("length_sum"),
        F.min("text_length").alias("length_min"),
        F.max("text_length").alias("length_max"),
        F.count("text_length").alias("length_n"),
    )
    # A bit of the id is set for each key that is not in the set, the first key's highest.
    bits = {name: 1 << at for at, name in enumerate(reversed(_KEYS))}
    ids = {fact: sum(bit for name, bit in bits.items() if name not in names) for fact, names in _SETS.items()}
    fact = F.coalesce(*[F.when(F.col("_id") == number, fact) for fact, number in ids.items()])
    return grouped.withColumn("fact", fact).drop("_id")


def link_facts(source: ChatSource) -> DataFrame:
    """Links of each chat: what the reports need of the links, from one scan."""
    return source.link.groupBy("chat_id").agg(F.count("message_id").alias("message_count"))


def reports(source: ChatSource, facts: DataFrame, links: DataFrame, k: int = 10, bins: int = 30) -> dict[str, DataFrame]:
    """The reports that follow from `message_facts` and `link_facts`; store these before.

    Each is what the function of the same name gives. Only chats and contacts are read beside the facts.
    """

    def of(fact: str) -> DataFrame:
        return facts.filter(F.col("fact") == fact)

    def size(frame: DataFrame, label: str) -> DataFrame:
        return frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("label"), "n")

    def by(name: str) -> DataFrame:
        return of(name).filter(F.col(name).isNotNull()).select(name, "n").orderBy(name)

    # Aggregated once more, because grouping sets give no row for no messages.
    none = F.lit(0)
    entire = of("all").agg(
        *[F.coalesce(F.sum(name), none).alias(name) for name in ("n", "media", "empty", "length_n")],
        *[F.min(name).alias(name) for name in ("first", "last", "length_sum", "length_min", "length_max")],
    )
    labels = {"Total messages": "n", "Messages with attachments": "media", "Empty messages": "empty"}
    pairs = [item for label, name in labels.items() for item in (F.lit(label), F.col(name))]
    counts = [
        entire.select(F.stack(F.lit(len(labels)), *pairs).alias("label", "n")),
        size(source.chat, "Total conversations"),
        size(source.handle, "Total contacts"),
    ]
    senders = of("sender").select("handle_id", "is_from_me", "n")
    return {
        "basic_counts": reduce(DataFrame.unionByName, counts),
        "count_by_service": of("service").select(
            tx.label_or(F.col("service"), F.lit("Unknown")).alias("service"), "n"
        ),
        "time_range": entire.select(
            clock_text(source_timestamp(F.col("first"))).alias("first_message"),
            clock_text(source_timestamp(F.col("last"))).alias("last_message"),
        ),
        "length_stats": entire.select(
            F.try_divide("length_sum", "length_n").alias("avg_length"),
            F.col("length_min").alias("min_length"),
            F.col("length_max").alias("max_length"),
            F.col("length_n").alias("count_with_text"),
        ),
        "messages_by_month": by("month"),
        "messages_by_hour": by("hour"),
        "length_histogram": _histogram(of("length").filter("length is not null").select("length", "n"), bins),
        "top_senders": _top_senders(senders, source.handle, k),
        "top_conversations": _top_conversations(links, source.chat, k),
    }
