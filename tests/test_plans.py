"""The plans a large cluster would run: what is pushed down, shuffled, broadcast, split."""

from __future__ import annotations

import contextlib
import io
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from chatlake.operators import conversations as cv
from chatlake.operators import export as ex
from chatlake.operators import extract as ext
from chatlake.operators import pairs, profile, split
from chatlake.operators.clean import clean
from chatlake.operators.keys import duplicate_ids
from chatlake.sources.tables import read_source, take_snapshot


@contextlib.contextmanager
def settings(spark, **values):
    names = {name.replace("_", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(frame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


def shuffles(text: str) -> list[str]:
    """Columns of each exchange that hashes or ranges rows."""
    blocks = re.split(r"\n\n(?=\(\d+\) )", text)
    return [b for b in blocks if re.match(r"\(\d+\) Exchange", b)]


@pytest.fixture(scope="module")
def big_source(spark, tmp_path_factory):
    """Stored source tables, with all joins planned as if no side were small."""
    from chatlake.sources.derived import derived_source

    root = tmp_path_factory.mktemp("source")
    source = derived_source(spark, "/root/testdata/sf0.01")
    for name, frame in (("message", source.message), ("chat", source.chat),
                        ("handle", source.handle), ("chat_message_join", source.link)):
        frame.write.parquet(f"{root}/{name}")
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="-1"):
        yield read_source(spark, str(root))


@pytest.fixture
def large_contacts(monkeypatch):
    """Take the path for contact tables too large to broadcast."""
    monkeypatch.setattr(ext.with_contact, "__defaults__", (0,))


def test_mark_and_content_reach_the_scan(big_source):
    text = plan(ext.extract(big_source, after=100))
    assert "GreaterThan(row_id,100)" in text
    assert "GreaterThan(message_id,100)" in text  # inferred for the link table
    assert "service" not in re.search(r"ReadSchema: .*attributedBody.*", text).group()


def test_text_is_shuffled_once(big_source, large_contacts):
    text = plan(ext.extract(big_source))
    with_text = [s for s in shuffles(text) if re.search(r"\btext#", s)]
    assert len(with_text) == 1 and "hashpartitioning(message_id" in with_text[0]
    assert "Broadcast" not in text


def test_contacts_are_the_same_on_both_paths(big_source):
    message = ext.new_messages(big_source).join(big_source.link, "message_id")
    small = ext.with_contact(message, big_source).select("message_id", "contact_id")
    large = ext.with_contact(message, big_source, 0).select("message_id", "contact_id")
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
    assert small.filter("contact_id is null").count() > 0


def test_unused_contacts_are_not_joined(big_source, large_contacts):
    rows = clean(ext.extract(big_source), sizes=big_source.link)
    assert "handle" not in plan(cv.training_examples(rows, "p")).replace("handle_id", "")


def test_body_is_decoded_once(big_source):
    text = plan(clean(ext.extract(big_source), sizes=big_source.link))
    decoded = [b for b in text.split("\n\n") if "regexp_extract_all" in b]
    assert len(decoded) == 1 and "Generate" in decoded[0]


def test_assembly_reuses_the_shuffle_of_the_index(big_source):
    rows = clean(ext.extract(big_source), sizes=big_source.link)
    text = plan(cv.training_examples(rows, "p"))
    assert len([s for s in shuffles(text) if re.search(r"\b(text|_cleaned|content)#", s)]) == 2
    assert "conversation_id" not in "".join(shuffles(text))


def test_pairs_reuse_the_shuffle_of_the_index(big_source):
    text = plan(pairs.reply_pairs(ex.export_messages(big_source)))
    assert len([s for s in shuffles(text) if re.search(r"\b(content|_cleaned)#", s)]) == 2


def test_no_single_partition_holds_rows(big_source):
    rows = clean(ext.extract(big_source), sizes=big_source.link)
    for frame in (
        rows,
        cv.training_examples(rows, "p"),
        pairs.reply_pairs(ex.export_messages(big_source)),
        duplicate_ids(ext.extract(big_source)),
    ):
        assert "SinglePartition" not in plan(frame)


def test_split_puts_only_bucket_counts_into_one_task(big_source):
    sizes = cv.conversation_sizes(clean(ext.extract(big_source), sizes=big_source.link))
    text = plan(split.assign_split(sizes, sizes))
    single = [s for s in shuffles(text) if "SinglePartition" in s]
    assert single and all("bucket#" in s and "conversation_id" not in s for s in single)


def test_no_python_workers(big_source):
    rows = clean(ext.extract(big_source), sizes=big_source.link)
    for frame in (cv.training_examples(rows, "p"), ex.export_messages(big_source)):
        text = plan(frame)
        assert "Python" not in text and "Arrow" not in text


SKEW = {
    "spark_sql_autoBroadcastJoinThreshold": "-1",
    "spark_sql_adaptive_autoBroadcastJoinThreshold": "-1",
    "spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes": "100KB",
    "spark_sql_adaptive_advisoryPartitionSizeInBytes": "100KB",
    "spark_sql_adaptive_skewJoin_skewedPartitionFactor": "2",
}


def test_busy_chat_is_split_by_the_adaptive_join(spark):
    """One chat with nearly all links, joined on its id, is cut into several tasks."""
    links = spark.range(300_000).select(
        F.when(F.col("id") % 10 > 0, F.lit(1)).otherwise(F.col("id")).cast("long").alias("chat_id"),
        F.col("id").alias("message_id"),
    )
    chat = spark.range(300_000).select(
        F.col("id").alias("row_id"),
        F.col("id").cast("string").alias("display_name"),
        F.lit("room").alias("room_name"),
    )
    with settings(spark, **SKEW):
        joined = ext.with_chat_names(links.repartition(8), chat)
        assert len(joined.collect()) == 300_000
        assert "skew=true" in plan(joined)


def contact_frames(spark, derived, shared_id):
    """Ten messages in eleven share one handle id; contacts have ids from 1."""
    message = spark.range(300_000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 11 > 0, F.lit(shared_id)).otherwise(F.col("id")).cast("long").alias(
            "handle_id"
        ),
    )
    handle = spark.range(1, 300_000).select(
        F.col("id").alias("row_id"), F.col("id").cast("string").alias("id")
    )
    source = replace(derived, message=message.repartition(8), handle=handle.repartition(8))
    return message.withColumnRenamed("row_id", "message_id"), source


def test_busy_contact_is_split_by_the_adaptive_join(spark, derived):
    rows, source = contact_frames(spark, derived, 5)
    with settings(spark, **SKEW):
        found = ext.with_contact(rows, source, broadcast_rows=0).select("message_id", "contact_id")
        contacts = found.collect()
        assert len(contacts) == 300_000
        assert sum(r.contact_id == "5" for r in contacts) == 272_727
        assert "skew=true" in plan(found)


def test_messages_without_contact_are_not_shuffled_for_one(spark, derived):
    rows, source = contact_frames(spark, derived, 0)
    with settings(spark, **SKEW):
        found = ext.with_contact(rows, source, broadcast_rows=0).select("message_id", "contact_id")
        contacts = found.collect()
        assert len(contacts) == 300_000
        assert sum(r.contact_id is not None for r in contacts) == 27_272
        assert "handle_id" in plan(found) and "<= 299999" in plan(found)


def scans(frame) -> list[str]:
    """The columns of each scan of the plan."""
    return re.findall(r"Scan parquet[\s\S]*?ReadSchema: struct<(.*?)>", plan(frame))


def test_reports_read_messages_and_links_once(big_source):
    facts, links = profile.message_facts(big_source), profile.link_facts(big_source)
    assert len(scans(facts)) == len(scans(links)) == 1
    assert "attributedBody" not in scans(facts)[0]
    assert len(shuffles(plan(facts))) == len(shuffles(plan(links))) == 1
    found = profile.reports(big_source, facts.filter("false"), links.filter("false"))
    assert len(found) == 9


def test_the_histogram_reads_texts_once(big_source):
    assert len(scans(profile.length_histogram(big_source))) == 1


def test_a_snapshot_bounds_every_scan(big_source):
    bounded = take_snapshot(big_source).of(big_source)
    text = plan(ext.extract(bounded, after=100))
    assert "GreaterThan(row_id,100)" in text
    assert len(re.findall(r"LessThanOrEqual\((?:row_id|message_id|chat_id),\d+\)", text)) >= 4


def test_a_split_computes_its_ids_once(big_source):
    sizes = cv.conversation_sizes(clean(ext.extract(big_source), sizes=big_source.link))
    found = split.split_once(sizes)
    assert all("text" not in columns for columns in scans(found))
    assert {len(columns.split(",")) for columns in scans(found)} <= {1, 2}
