from pyspark.sql import functions as F

from chatlake.operators.clean import chat_sizes, clean
from chatlake.operators.conversations import conversation_stats
from chatlake.plans.jobs import run_clean, run_extract, run_from_scratch
from chatlake.sources.store import CLEAN, EXTRACT
from tests import data


def store_messages(store, rows, batch_id, last_id):
    attempt = store.write_batch(EXTRACT, rows, batch_id)
    store.commit(EXTRACT, batch_id, attempt, last_id, rows.count())


def test_clean_fixture(spark):
    rows = clean(data.extracted(spark)).orderBy("message_id").collect()
    assert [(r.message_id, r.conversation_id, r.message_index) for r in rows] == [
        (31, "convo_5", 0), (34, "convo_5", 1), (35, "convo_5", 2),
        (38, "convo_8", 0), (39, "convo_8", 1)]


def test_conversation_stats(spark):
    stats = conversation_stats(clean(data.extracted(spark))).orderBy("conversation_id")
    assert [tuple(r) for r in stats.collect()] == [("convo_5", 3, 1, 1), ("convo_8", 2, 1, 0)]


def test_index_follows_time_then_id(spark):
    rows = [
        data.extracted_row(5, 1, "b", minute=1),
        data.extracted_row(2, 1, "c", minute=1),
        data.extracted_row(9, 1, "a", minute=0),
    ]
    found = clean(data.extracted(spark, rows)).orderBy("message_index").collect()
    assert [r.message_id for r in found] == [9, 2, 5]


def test_incremental_runs_with_both_index_scopes(spark, store):
    store_messages(store, data.extracted(spark), 0, 39)
    assert run_clean(store) == 5
    assert store.mark(CLEAN) == 39
    assert run_clean(store) == 0
    new = data.extracted(spark, [data.extracted_row(40, 5, "Two cups, then", minute=50)])
    store_messages(store, new, 39, 40)
    assert run_clean(store, index_scope="conversation") == 1
    row = store.read(CLEAN).filter("message_id = 40").first()
    assert (row.conversation_id, row.message_index) == ("convo_5", 3)


def test_batch_scope_starts_over(spark, store):
    store_messages(store, data.extracted(spark), 0, 39)
    run_clean(store)
    new = data.extracted(spark, [data.extracted_row(40, 5, "Two cups, then", minute=50)])
    store_messages(store, new, 39, 40)
    assert run_clean(store) == 1
    assert store.read(CLEAN).filter("message_id = 40").first().message_index == 0


def test_mark_is_the_last_surviving_id(spark, store):
    rows = [data.extracted_row(1, 1, "still here"), data.extracted_row(2, 1, "someone reacted with x")]
    store_messages(store, data.extracted(spark, rows), 0, 2)
    assert run_clean(store) == 1
    assert store.mark(CLEAN) == 1


def test_two_batches_equal_one(spark):
    rows = [data.extracted_row(n, n % 3, f"text {n}") for n in range(1, 31)]
    everything = clean(data.extracted(spark, rows))
    early = clean(data.extracted(spark, rows[:17]))
    late = clean(data.extracted(spark, rows[17:]), earlier=chat_sizes(early))
    columns = ["message_id", "conversation_id", "message_index"]
    one = {tuple(r) for r in everything.select(columns).collect()}
    assert one == {tuple(r) for r in early.unionByName(late).select(columns).collect()}


def test_hot_chat_is_numbered_like_any_other(spark):
    rows = [data.extracted_row(n, 0 if n % 3 else n, f"text {n}", minute=n % 4)
            for n in range(1, 200)]
    messages = data.extracted(spark, rows).repartition(5, F.rand(3))
    columns = ["message_id", "chat_id", "message_index"]
    plain = {tuple(r) for r in clean(messages).select(columns).collect()}
    hot = {tuple(r) for r in clean(messages, hot_rows=20).select(columns).collect()}
    assert plain == hot and len(hot) == 199


def test_from_scratch_and_reset(spark, store, derived):
    assert run_from_scratch(derived, store) == (70, 62)
    assert run_extract(derived, store) == 0 and run_clean(store) == 0
    store.reset()
    assert store.read(EXTRACT).count() == 70 and store.read(CLEAN).count() == 0
    assert store.mark(CLEAN) == 0 and store.mark(EXTRACT) > 0
    assert run_clean(store) == 62
    store.reset(include_raw=True)
    assert store.read(EXTRACT).count() == 0 and store.mark(EXTRACT) == 0
    assert run_from_scratch(derived, store) == (70, 62)
