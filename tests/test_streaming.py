import os
import time

import pytest
from pyspark.sql import functions as F

from chatlake import schemas
from chatlake.operators.clean import clean
from chatlake.operators.extract import extract
from chatlake.operators.keys import DuplicateMessageError
from chatlake.sources.store import CLEAN, EXTRACT, UNLINKED
from chatlake.streaming import available_now
from tests import data

HOUR = 3600


class Folders:
    """Two folders that a stream reads, with files of a chosen time of arrival."""

    def __init__(self, spark, base):
        self.spark, self.base, self.now = spark, base, int(time.time()) - 100 * HOUR

    def add(self, name, rows, at):
        schema = schemas.MESSAGE if name == "message" else schemas.LINK
        folder = self.base / name
        before = set(folder.glob("*.parquet"))
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        for path in set(folder.glob("*.parquet")) - before:
            os.utime(path, (self.now + at, self.now + at))

    def run(self, store, tables, wait="2 hours"):
        def stream(name, schema):
            reader = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            return reader.parquet(str(self.base / name))

        query = available_now.start(
            stream("message", schemas.MESSAGE), stream("chat_message_join", schemas.LINK),
            tables, store, str(self.base / "checkpoint"), wait,
        )
        query.awaitTermination()
        assert query.exception() is None
        return query


@pytest.fixture
def folders(spark, tmp_path):
    return Folders(spark, tmp_path)


def batch(source):
    """Rows as the join of the streams gives them."""
    return source.message.join(source.link, F.col("row_id") == F.col("message_id"))


def test_stream_equals_batch_whichever_comes_first(spark, store, folders):
    texts = [f"text {n}" if n % 4 else "Liked it" for n in range(1, 41)]
    messages = [data.message(n, t, date=n * 10**9) for n, t in enumerate(texts, 1)]
    links = [(1 + n % 2, n) for n in range(1, 41)]
    source = data.source(spark, messages, links)

    folders.add("message", messages[:15], 0)
    folders.add("chat_message_join", links[:5] + links[20:30], 60)
    folders.run(store, lambda: source)
    assert store.read(EXTRACT).count() == 4
    folders.add("chat_message_join", links[5:20], HOUR)
    folders.add("message", messages[28:], HOUR)
    folders.add("message", messages[15:28], HOUR + 60)
    folders.add("chat_message_join", links[30:], HOUR + 120)
    assert available_now.late_rows(folders.run(store, lambda: source)) == 0
    folders.run(store, lambda: source)
    columns = ["message_id", "chat_id", "text", "timestamp", "conversation_id"]
    expected = clean(extract(source))
    found = store.read(CLEAN)
    assert found.count() == 30 and store.read(UNLINKED).count() == 0
    assert {tuple(r) for r in found.select(columns).collect()} == \
        {tuple(r) for r in expected.select(columns).collect()}
    per_chat = found.groupBy("chat_id").agg({"message_index": "max", "*": "count"}).collect()
    assert all(r["max(message_index)"] == r["count(1)"] - 1 for r in per_chat)


def test_state_is_bounded_by_the_wait(spark, store, folders):
    messages = [data.message(n, f"text {n}", date=n * 10**9) for n in range(1, 5)]
    source = data.source(spark, messages, [])
    folders.add("message", messages[:2], 0)
    folders.add("chat_message_join", [(1, 2), (1, 77)], 60)
    folders.run(store, lambda: source)
    for step in range(1, 4):  # time goes on in both streams
        folders.add("message", [messages[3]] if step == 3 else [data.message(50 + step, None)], 4 * step * HOUR)
        folders.add("chat_message_join", [(1, 4)] if step == 3 else [(1, 80 + step)], 4 * step * HOUR)
        query = folders.run(store, lambda: source)
    folders.add("chat_message_join", [(1, 1)], 12 * HOUR)  # much too late for message 1
    query = folders.run(store, lambda: source)
    assert sorted(r.message_id for r in store.read(EXTRACT).collect()) == [2, 4]
    assert [r.row_id for r in store.read(UNLINKED).collect()] == [1]
    kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert kept <= 4  # message 4 and links of the last hours, not the early ones


def test_replayed_batch_replaces_itself(spark, store):
    source = data.source(spark)
    for _ in range(2):
        available_now.process_batch(batch(source), 0, lambda: source, store)
    assert store.read(EXTRACT).count() == 3 and store.read(CLEAN).count() == 3
    assert sorted(r.message_index for r in store.read(CLEAN).collect()) == [0, 0, 1]


def test_a_failed_replay_leaves_the_committed_batch(spark, store):
    source = data.source(spark)
    available_now.process_batch(batch(source), 0, lambda: source, store)
    before = {tuple(r) for r in store.read(EXTRACT).collect()}
    doubled = data.source(spark, links=[*data.LINKS, (2, data.LINKS[0][1])])
    with pytest.raises(DuplicateMessageError):
        available_now.process_batch(batch(doubled), 0, lambda: doubled, store)
    assert {tuple(r) for r in store.read(EXTRACT).collect()} == before
    assert store.read(CLEAN).count() == 3


def test_messages_wait_for_their_chat_to_be_listed(spark, store):
    messages = [data.message(n, f"text {n}", date=n * 10**9) for n in range(1, 5)]
    early = data.source(spark, messages, [(1, 1), (1, 2), (7, 3), (8, 4)])
    late = data.source(spark, messages, [], chats=[*data.CHATS, (7, "", "Late"), (8, "", "Later")])
    available_now.process_batch(batch(early).filter("row_id < 4"), 0, lambda: early, store)
    available_now.process_batch(batch(early).filter("row_id = 4"), 1, lambda: early, store)
    assert {(r.row_id, r.chat_id) for r in store.waiting_before(2).collect()} == {(3, 7), (4, 8)}
    nothing = batch(early).limit(0)
    for _ in range(2):  # the second time as a replay
        available_now.process_batch(nothing, 2, lambda: late, store)
        assert sorted(r.message_id for r in store.read(CLEAN).collect()) == [1, 2, 3, 4]
    assert store.waiting_before(3).count() == 0
    available_now.process_batch(nothing, 3, lambda: late, store)
    assert store.waiting_before(4).count() == 0
    assert store.progress("wait").filter("batch_id = 3").isEmpty()


def test_unlinked_messages_of_a_replay_replace_themselves(spark, store):
    source = data.source(spark)
    rows = batch(source).withColumn("chat_id", F.when(F.col("row_id") > 12, F.col("chat_id")))
    for _ in range(2):
        available_now.process_batch(rows, 0, lambda: source, store)
    assert sorted(r.row_id for r in store.read(UNLINKED).collect()) == [11, 12]


def test_reset_reads_everything_again(spark, store, folders):
    source = data.source(spark)
    folders.add("message", data.MESSAGES, 0)
    folders.add("chat_message_join", data.LINKS, 0)
    folders.run(store, lambda: source)
    available_now.reset(store, str(folders.base / "checkpoint"))
    assert store.read(EXTRACT).count() == 0
    folders.run(store, lambda: source)
    assert store.read(EXTRACT).count() == 3


def test_late_low_ids_are_taken(spark, store):
    source = data.source(spark)
    for batch_id, ids in enumerate(([21], [11, 12])):
        rows = batch(source).filter(F.col("row_id").isin(ids))
        available_now.process_batch(rows, batch_id, lambda: source, store)
    assert store.read(CLEAN).count() == 3
