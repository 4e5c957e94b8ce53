import json
import re

import pytest
from pyspark.sql import functions as F

from chatlake.operators import export as ex
from chatlake.operators import pairs, style
from chatlake.operators.numbering import number_rows
from chatlake.plans.jobs import run_export
from chatlake.sources.documents import read_documents
from tests import data

PROMPT = "be brief"


def roles(spark, sequence, chat_id=1):
    names = {"F": "friend", "S": "self"}
    rows = [(chat_id, n, names[c], f"{c}{n}") for n, c in enumerate(sequence)]
    return spark.createDataFrame(
        rows, "chat_id long, message_index long, role string, content string")


@pytest.mark.parametrize("sequence,expected", [
    ("FS", [0]), ("FSFS", [0, 2]), ("FFS", [0]), ("SFS", [0]), ("FSFFS", [0, 0]),
    ("SS", []), ("FF", []), ("", [])])
def test_pairs_of_short_sequences(spark, sequence, expected):
    found = pairs.reply_pairs(roles(spark, sequence)).orderBy("message_index").collect()
    assert [len(r.context) for r in found] == expected


@pytest.mark.parametrize("block_rows", [4, 5, 1000])
def test_pairs_by_what_they_have_to_be(spark, block_rows):
    """Each own message right after a friend's is one reply; the four rows up to it decide on the context."""
    import random
    sequence = "".join(random.Random(2).choices("FS", k=200))
    found = {r.message_index: r for r in pairs.reply_pairs(roles(spark, sequence), block_rows=block_rows).collect()}
    replies = {m.start() for m in re.finditer("(?=FS)", sequence)}
    exchanges = {m.start() + 2 for m in re.finditer("(?=FSFS)", sequence)}
    assert set(found) == replies and len(replies) > 40 and len(exchanges) > 5
    for at, row in found.items():
        assert (row.question, row.reply) == (f"F{at}", f"S{at + 1}")
        assert [m.content for m in row.context] == ([f"F{at - 2}", f"S{at - 1}"] if at in exchanges else [])


def test_pair_line(spark):
    row = pairs.reply_pairs(roles(spark, "FSFS")).select(
        "message_index", pairs.pair_line(PROMPT).alias("line")).orderBy("message_index").collect()
    assert json.loads(row[1].line) == {"messages": [
        {"role": "system", "content": "be brief"},
        {"role": "user", "content": "F0"}, {"role": "assistant", "content": "S1"},
        {"role": "user", "content": "F2"}, {"role": "assistant", "content": "S3"}]}


def chat_source(spark, texts, name=None, system=0):
    messages = [data.message(n, text, own=n % 2, date=n * 10**9, system=system)
                for n, text in enumerate(texts, 1)]
    links = [(1, n) for n in range(1, len(texts) + 1)]
    return data.source(spark, messages, links, [(1, None, name)])


def test_export_minimums(spark):
    kept = ["a", "b", "\ufffcc", "d", "e"]
    assert ex.export_messages(chat_source(spark, kept)).count() == 5
    assert ex.export_messages(chat_source(spark, [*kept[:4], "Liked x"])).count() == 0
    assert ex.export_messages(chat_source(spark, kept[:3]), min_clean=1).count() == 0
    # System messages count here, unlike in the incremental path.
    assert ex.export_messages(chat_source(spark, kept, system=1)).count() == 5


def test_export_document(spark):
    source = chat_source(spark, ["a", "b", "\ufffcc", "d", "e"])
    rows = ex.export_messages(source)
    (doc,) = ex.export_conversations(rows, source.chat).collect()
    assert (doc.id, doc.title, doc.message_count, doc.part) == (
        "conversation_1", "Conversation-1", 5, 0)
    first, third = doc.messages[0], doc.messages[2]
    assert (first.role, first.content, first.contact_id, first.has_media, first.timestamp) == (
        "self", "a", "me", False, "2001-01-01 00:00:01")
    assert (third.content, third.has_media) == ("c", True)
    assert doc.messages[1].contact_id == data.PHONE_A
    parts = ex.export_conversations(rows, source.chat, part_messages=2).orderBy("part").collect()
    assert [m for p in parts for m in p.messages] == doc.messages
    assert {p.message_count for p in parts} == {5}


def test_export_of_hot_chats(spark, derived):
    plain = ex.export_messages(derived)
    hot = ex.export_messages(derived, hot_rows=2)
    assert plain.count() == 28
    assert plain.exceptAll(hot).count() == 0 and hot.exceptAll(plain).count() == 0


def test_derived_golden_counts(spark, derived):
    rows = ex.export_messages(derived)
    found = pairs.reply_pairs(rows)
    assert found.count() == 10
    assert found.filter(F.size("context") > 0).count() == 4


def test_style_without_own_messages(spark):
    stats = style.style_stats(roles(spark, "FF"))
    assert tuple(stats.first()) == (0, 0.0, 0.0)
    assert "about 0.00 emojis" in style.render_prompt(stats).first().prompt


def test_prompt_and_variants(spark):
    rows = spark.createDataFrame([("self", "a" * 62 + "😀"), ("self", "b" * 62)],
                                 "role string, content string")
    prompt = style.render_prompt(style.style_stats(rows), "%s emojis, %s characters")
    assert prompt.first().prompt == "0.50 emojis, 62 characters"
    variants = style.prompt_variants(prompt, [" x", " y"]).orderBy("variant").collect()
    assert [v.prompt.removeprefix("0.50 emojis, 62 characters") for v in variants] == [
        "", " x", " y"]


def test_export_job(spark, tmp_path, derived):
    target = run_export(derived, str(tmp_path))
    documents = read_documents(spark, target.documents)
    assert documents.count() == 5 and documents.filter("part is not null").count() == 0
    pairs_written = [json.loads(r.value) for r in spark.read.text(target.message_pairs).collect()]
    assert len(pairs_written) == 10
    texts = [r.value for r in spark.read.text(target.documents).collect() if r.value.strip()]
    assert all("contact_id" in m for t in texts for m in json.loads(t)["messages"])
    lines = [r.value for r in spark.read.text(target.full_conversations).collect()]
    whole = [json.loads(line) for line in lines if line.strip()]
    assert len(whole) == 5
    variants = spark.read.json(target.prompts).orderBy("variant").collect()
    assert len(variants) == 4
    for example in (*pairs_written, *whole):
        assert example["messages"][0] == {"role": "system", "content": variants[0].prompt}


def test_by_size_orders_documents(spark, derived):
    documents = ex.export_conversations(ex.export_messages(derived), derived.chat)
    counts = [r.linked_count for r in ex.by_size(documents).collect()]
    assert counts == sorted(counts, reverse=True)


def test_number_rows_total_is_used_for_the_minimum(spark):
    rows = roles(spark, "FSFSF")
    total = number_rows(rows, "chat_id", ("message_index",), "p", "n", hot_rows=2)
    assert {r.n for r in total.collect()} == {5}
