import pytest

from chatlake.operators.extract import chat_lookup, extract
from chatlake.operators.keys import DuplicateMessageError, duplicate_ids
from chatlake.plans.jobs import run_extract
from chatlake.sources.store import EXTRACT
from tests import data


def test_three_of_seven_rows(spark):
    rows = extract(data.source(spark)).orderBy("message_id").collect()
    assert [(r.message_id, r.text, r.chat_name, r.room_name, r.has_media, r.is_from_me)
            for r in rows] == [
        (11, "See you at nine", "Neighbours", "garden", 0, 0),
        (12, "On my way", "Neighbours", "garden", 0, 1),
        (21, "Who brings the cake?", "Cooks", "kitchen", 0, 0),
    ]
    assert str(rows[0].timestamp) == "2021-03-04 05:06:07"
    assert [r.contact_id for r in rows] == [data.PHONE_A, data.PHONE_A, data.PHONE_B]


def test_null_flags_unknown_contacts_and_room_fallback(spark):
    messages = [
        data.message(1, "null flag", system=None),
        data.message(2, "no contact", handle=0, own=1),
        data.message(3, "empty room", room="cached"),
        data.message(4, "", room=None),
        data.message(5, "text with media", media=1),
    ]
    chats = [(1, "", None)]
    source = data.source(spark, messages, [(1, n) for n in range(1, 6)], chats)
    rows = {r.message_id: r for r in extract(source).collect()}
    assert sorted(rows) == [2, 3, 4, 5]
    assert rows[2].contact_id is None
    assert rows[3].room_name == "cached"
    assert rows[4].room_name is None and rows[4].text == ""
    assert rows[5].has_media == 1


def test_chat_lookup(spark):
    source = data.source(spark, chats=[*data.CHATS])
    rows = chat_lookup(spark.createDataFrame([(1,), (2,), (9,)], "chat_id long"), source.chat)
    assert {r.chat_id: (r.chat_room_name, r.chat_name) for r in rows.collect()} == {
        1: ("garden", "Neighbours"), 2: ("kitchen", "Cooks"), 9: (None, None)}


def test_incremental_runs(spark, store):
    assert run_extract(data.source(spark), store) == 3
    # Message 21 is the last one that passes the flags; 24 is a system message.
    assert store.mark(EXTRACT) == 21
    assert run_extract(data.source(spark), store) == 0
    more = [*data.MESSAGES, data.message(30, "I do, with cherries")]
    source = data.source(spark, more, [*data.LINKS, (1, 30)])
    assert run_extract(source, store) == 1
    assert store.read(EXTRACT).count() == 4
    assert store.mark(EXTRACT) == 30


def test_mark_counts_rows_the_text_rules_drop(spark, store):
    messages = [data.message(1, "still here"), data.message(2, "Loved it")]
    source = data.source(spark, messages, [(1, 1), (1, 2)])
    assert run_extract(source, store) == 1
    assert store.mark(EXTRACT) == 2


def test_mark_stays_when_nothing_survives(spark, store):
    source = data.source(spark, [data.message(5, "Liked it")], [(1, 5)])
    assert run_extract(source, store) == 0
    assert store.mark(EXTRACT) == 0


def test_message_in_two_chats_is_rejected(spark, store):
    source = data.source(spark, links=[*data.LINKS, (2, 11)])
    assert [r.message_id for r in duplicate_ids(extract(source)).collect()] == [11]
    with pytest.raises(DuplicateMessageError):
        run_extract(source, store)
    assert store.read(EXTRACT).count() == 0 and store.mark(EXTRACT) == 0
    assert run_extract(data.source(spark), store) == 3


def test_stored_ids_are_rejected(spark, store):
    run_extract(data.source(spark), store)
    again = extract(data.source(spark))
    with pytest.raises(DuplicateMessageError):
        store.write_batch(EXTRACT, again, 77)
    assert store.read(EXTRACT).count() == 3


def test_uncommitted_batch_is_invisible_and_replaced(spark, store):
    store.write_batch(EXTRACT, extract(data.source(spark)), store.mark(EXTRACT))
    assert store.read(EXTRACT).count() == 0
    assert run_extract(data.source(spark), store) == 3
    assert store.read(EXTRACT).count() == 3
