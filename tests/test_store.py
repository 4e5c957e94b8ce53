import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chatlake import schemas
from chatlake.plans.jobs import run_extract
from chatlake.operators.clean import clean
from chatlake.operators.keys import DuplicateMessageError, id_runs
from chatlake.sources.store import CLEAN, EXTRACT, decode_legacy_mark, latest_mark
from chatlake.sources.tables import (
    conform,
    list_columns,
    list_tables,
    read_source,
    source_from_catalog,
    source_from_jdbc,
    take_snapshot,
)
from tests import data


def test_create_makes_tables_with_exact_columns(spark, store):
    store.create()
    names = {r.table_name for r in list_tables(spark, store.database).collect()}
    assert names == {"messages", "cleaned_messages", "waiting_messages", "unlinked_messages",
                     "chat_totals", "progress"}
    columns = {r.column_name for r in
               list_columns(spark, f"{store.database}.messages").collect()}
    assert columns - {"batch_id", "attempt"} == set(schemas.EXTRACTED.fieldNames())
    columns = {r.column_name for r in
               list_columns(spark, f"{store.database}.cleaned_messages").collect()}
    assert columns - {"batch_id", "attempt"} == set(schemas.CLEANED.fieldNames())


def test_mark_defaults_to_zero_and_takes_the_newest(spark, store):
    assert store.mark(EXTRACT) == 0
    store.commit(EXTRACT, 0, "a", 250, 3)
    store.commit(EXTRACT, 250, "b", 100, 1)
    assert store.mark(EXTRACT) == 100
    rows = [(5, datetime(2024, 1, 2)), (9, datetime(2024, 1, 1))]
    status = spark.createDataFrame(rows, "last_id long, updated_at timestamp")
    assert latest_mark(status).first().last_id == 5


def test_legacy_mark(spark):
    values = [0, 1, 255, 256, 5720, 2**40 + 3]
    rows = [(v, bytearray(v.to_bytes(8, "little"))) for v in values] + [(0, bytearray(b""))]
    frame = spark.createDataFrame(rows, "v long, b binary")
    assert frame.select(F.col("v") == decode_legacy_mark(F.col("b"))).distinct().collect() == [
        (True,)]


def test_a_status_table_is_taken_over(spark, store):
    rows = [(bytearray((300).to_bytes(8, "little")), datetime(2024, 1, 2)),
            (bytearray((900).to_bytes(8, "little")), datetime(2024, 1, 1))]
    assert store.import_mark(EXTRACT, spark.createDataFrame(rows, "last_id binary, updated_at timestamp")) == 300
    assert store.mark(EXTRACT) == 300 and store.read(EXTRACT).count() == 0


def test_source_readers(spark, tmp_path):
    source = data.source(spark)
    for name, frame in (("message", source.message), ("chat", source.chat),
                        ("handle", source.handle), ("chat_message_join", source.link)):
        frame.write.parquet(str(tmp_path / name))
    back = read_source(spark, str(tmp_path))
    assert back.message.count() == 7 and back.link.count() == 7
    raw = source.chat.withColumnRenamed("row_id", "ROWID").withColumn("extra", F.lit(1))
    assert conform(raw, "chat").columns == ["row_id", "room_name", "display_name"]


def test_source_from_catalog(spark, tmp_path):
    source = data.source(spark)
    spark.sql(f"CREATE DATABASE chat_src LOCATION '{tmp_path}'")
    try:
        for name, frame in (("message", source.message), ("chat", source.chat),
                            ("handle", source.handle), ("chat_message_join", source.link)):
            renamed = frame.withColumnRenamed("row_id", "ROWID")
            renamed.write.saveAsTable(f"chat_src.{name}")
        assert source_from_catalog(spark, "chat_src").message.count() == 7
    finally:
        spark.sql("DROP DATABASE chat_src CASCADE")


class FakeReader:
    """Stands in for the JDBC reader; answers the reader's statements from frames.

    `later` are the tables as they are once the bounds have been read.
    """

    def __init__(self, session):
        self.session, self.set = session, {}

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **values):
        self.set |= values
        return self

    def load(self):
        session = self.session
        session.seen.append(self.set)
        query = self.set["dbtable"].removeprefix("(").removesuffix(") AS source_rows")
        if query.startswith("SELECT (SELECT min(ROWID)"):
            ends = {}
            for table, frame in session.frames.items():
                ends[f"{table}_min"], ends[f"{table}_max"] = frame.agg(F.min("row_id"), F.max("row_id")).first()
            assert set(re.findall(r"AS (\w+)", query)) == set(ends)
            return session.spark.createDataFrame([tuple(ends.values())], ", ".join(f"{n} long" for n in ends))
        table, where = re.fullmatch(r"SELECT ROWID AS row_id, .* FROM (\w+) WHERE (.*)", query).groups()
        return session.later[table].withColumn("ROWID_", F.col("row_id")).filter(re.sub("ROWID", "ROWID_", where))


class FakeSession:
    def __init__(self, spark, source, later=None):
        self.spark, self.seen = spark, []
        self.frames, self.later = self.tables(source), self.tables(later or source)

    @staticmethod
    def tables(source):
        return {"message": source.message, "chat": source.chat, "handle": source.handle,
                "chat_message_join": source.link.withColumn("row_id", F.col("message_id"))}

    @property
    def read(self):
        return FakeReader(self)


def grown(spark):
    """The small source after more was written to each of its tables."""
    return data.source(
        spark,
        [*data.MESSAGES, data.message(30, "written later", handle=3)],
        [*data.LINKS, (2, 30), (3, 30)],
        [*data.CHATS, (3, "cellar", "Later")],
        [*data.HANDLES, (3, "+15550000003")],
    )


def rows(source):
    return {name: sorted(map(tuple, getattr(source, name).collect())) for name in ("message", "chat", "handle", "link")}


def test_jdbc_reads_are_partitioned_on_the_row_number(spark):
    fake = FakeSession(spark, data.source(spark))
    back = source_from_jdbc(fake, "jdbc:x:y", partitions=5, driver="d")
    assert back.message.count() == 7 and back.link.columns == ["chat_id", "message_id"]
    reads = [options for options in fake.seen if "partitionColumn" in options]
    assert len(reads) == 4
    assert all(r["numPartitions"] == "5" and r["driver"] == "d" for r in reads)
    assert (reads[0]["lowerBound"], reads[0]["upperBound"]) == ("11", "24")


def test_jdbc_reads_all_tables_as_of_one_statement(spark):
    fake = FakeSession(spark, data.source(spark), later=grown(spark))
    assert rows(source_from_jdbc(fake, "jdbc:x:y")) == rows(data.source(spark))
    statements = [options["dbtable"] for options in fake.seen]
    assert len(statements) == 5 and statements[0].count("SELECT") == 9
    bounds = dict(re.search(r"FROM (\w+) WHERE (.*)\) AS", statement).groups() for statement in statements[1:])
    assert bounds == {
        "message": "ROWID <= 24",
        "chat": "ROWID <= 2",
        "handle": "ROWID <= 2",
        "chat_message_join": "ROWID <= 24 AND message_id <= 24 AND chat_id <= 2",
    }


def test_jdbc_reads_above_the_mark_only(spark):
    fake = FakeSession(spark, data.source(spark))
    back = source_from_jdbc(fake, "jdbc:x:y", after=16)
    assert sorted(r.row_id for r in back.message.collect()) == [18, 21, 24]
    assert sorted(r.message_id for r in back.link.collect()) == [18, 21, 24]
    message = next(o for o in fake.seen if " FROM message WHERE" in o["dbtable"])
    assert (message["lowerBound"], message["upperBound"]) == ("17", "24")


def test_jdbc_reads_empty_tables(spark):
    fake = FakeSession(spark, data.source(spark, [], [], [], []), later=grown(spark))
    assert rows(source_from_jdbc(fake, "jdbc:x:y")) == {"message": [], "chat": [], "handle": [], "link": []}


def test_a_snapshot_does_not_change(spark, tmp_path):
    def add(source):
        for name, frame in (("message", source.message), ("chat", source.chat),
                            ("handle", source.handle), ("chat_message_join", source.link)):
            frame.write.mode("append").parquet(str(tmp_path / name))

    before = data.source(spark)
    add(before)
    snapshot = take_snapshot(read_source(spark, str(tmp_path)))
    assert (snapshot.message, snapshot.chat, snapshot.handle) == (24, 2, 2)
    add(data.source(spark, [data.message(30, "later", handle=3)], [(2, 30), (3, 30)], [(3, "", "Later")], [(3, "x")]))
    assert read_source(spark, str(tmp_path)).message.count() == 8
    again = read_source(spark, str(tmp_path), snapshot=snapshot)
    assert rows(again) == rows(before)
    for frame, bound in ((again.message, "LessThanOrEqual(row_id,24)"), (again.link, "LessThanOrEqual(message_id,24)"),
                         (again.chat, "LessThanOrEqual(row_id,2)"), (again.handle, "LessThanOrEqual(row_id,2)")):
        assert bound in frame._jdf.queryExecution().executedPlan().toString()


def test_a_snapshot_of_nothing_is_empty(spark):
    empty = data.source(spark, [], [], [], [])
    assert rows(take_snapshot(empty).of(grown(spark))) == {"message": [], "chat": [], "handle": [], "link": []}


def test_a_run_sees_the_source_as_it_was_at_its_start(spark, store, tmp_path):
    """Rows that arrive once the run has begun wait for the next run."""
    now, calls = data.source(spark), []

    class Growing:
        """Shows more messages after the snapshot's query."""

        chat, handle, link = now.chat, now.handle, grown(spark).link

        @property
        def message(self):
            calls.append(1)
            return now.message if len(calls) == 1 else grown(spark).message

    assert run_extract(Growing(), store) == 3
    assert store.mark(EXTRACT) == 21
    assert run_extract(grown(spark).__class__(grown(spark).message, now.chat, now.handle, grown(spark).link.filter("chat_id < 3")), store) == 1


def commit(store, stage, ids, batch_id):
    rows = data.extracted(store.spark, [data.extracted_row(n, 1 + n % 3, f"text {n}") for n in ids])
    if stage == CLEAN:
        rows = clean(rows)
    attempt = store.write_batch(stage, rows, batch_id)
    store.commit(stage, batch_id, attempt, max(ids), len(ids))
    return attempt


def rows_read(frame, table):
    """Rows that the scan of a stored table gives to what follows it."""
    spark = frame.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = frame.select("*")._jdf.queryExecution()
        execution.toRdd().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    leaves = execution.executedPlan().collectLeaves()
    scans = [leaves.apply(at) for at in range(leaves.size())]
    found = [scan.metrics().apply("numOutputRows").value() for scan in scans if f".{table}" in scan.toString()]
    assert len(found) == 1
    return found[0]


def test_a_late_id_opens_only_the_files_around_it(spark, store):
    for number in range(8):
        commit(store, EXTRACT, range(1000 * number + 2, 1000 * number + 102), 1000 * number)
    batch = data.extracted(spark, [data.extracted_row(n, 1, "x") for n in [1005, *range(9000, 9100)]])
    near = store._stored_near(EXTRACT, batch, 9000)
    assert rows_read(near.select("message_id", "batch_id"), "messages") <= 100
    with pytest.raises(DuplicateMessageError):
        store.write_batch(EXTRACT, batch, 9000)
    assert store.read(EXTRACT).count() == 800
    commit(store, EXTRACT, [1, *range(9000, 9100)], 9000)
    assert store.read(EXTRACT).count() == 901


@pytest.mark.parametrize("ids", [[], [7], [1, 2, 3], [5, 10**12], list(range(0, 10**9, 10**6)), [-(2**62), 0, 2**62 - 1]])
def test_runs_hold_all_ids(spark, ids):
    runs = id_runs(spark.createDataFrame([(n,) for n in ids], "message_id long"), most=8)
    assert len(runs) <= 8 and all(any(low <= n <= high for low, high in runs) for n in ids)
    assert all(low in ids and high in ids for low, high in runs)
    assert all(before[1] < after[0] for before, after in zip(runs, runs[1:]))


def test_totals_are_one_row_for_each_chat(spark, store):
    for number in range(5):
        commit(store, CLEAN, range(10 * number + 1, 10 * number + 10), 10 * number)
    totals = {r.chat_id: r.message_count for r in store.sizes_before(50).collect()}
    assert totals == {1: 15, 2: 15, 3: 15}
    assert store.sizes_before(50).count() == 3
    assert rows_read(store.sizes_before(50), "chat_totals") == 3
    # A replay of the last batch goes on from the totals before it.
    assert sum(r.message_count for r in store.sizes_before(40).collect()) == 36
    commit(store, CLEAN, range(41, 50), 40)
    assert sum(r.message_count for r in store.sizes_before(50).collect()) == 45
    stored = spark.sql(f"SHOW PARTITIONS {store.database}.chat_totals").collect()
    assert {r.partition.split("/")[0] for r in stored} == {"batch_id=30", "batch_id=40"}
    assert len(stored) == 2


def test_attempts_that_died_go_with_the_commit(spark, store):
    rows = data.extracted(spark, [data.extracted_row(1, 1, "x")])
    store.write_batch(EXTRACT, rows, 0)
    store.write_batch(EXTRACT, rows, 5)
    kept = commit(store, EXTRACT, [1], 0)
    names = {r.partition for r in spark.sql(f"SHOW PARTITIONS {store.database}.messages").collect()}
    assert len(names) == 2 and f"batch_id=0/attempt={kept}" in names


def test_marks_are_compacted_and_none_is_lost(spark, store, monkeypatch):
    monkeypatch.setattr("chatlake.sources.store.COMPACT_AFTER", 3)
    for n in range(1, 10):
        store.commit(EXTRACT, n, f"a{n}", 10 * n, n)
        store.commit(CLEAN, n, f"c{n}", 5 * n, n) if n < 3 else None
    store.commit(EXTRACT, 4, "again", 40, 4)  # a batch that is run once more
    found = {r.batch_id: (r.attempt, r.last_id, r.row_count) for r in store.progress(EXTRACT).collect()}
    assert found == {n: ("again" if n == 4 else f"a{n}", 10 * n, n) for n in range(1, 10)}
    assert store.mark(CLEAN) == 10 and store.progress(CLEAN).count() == 2
    assert len(store._eras(EXTRACT)) == 1 and len(store._eras(CLEAN)) == 1
    files = spark.table(f"{store.database}.progress").filter("stage = 'extract'").select("_metadata.file_path")
    assert files.distinct().count() <= 4
    store.reset(include_raw=True)
    assert store.mark(EXTRACT) == 0 and store.mark(CLEAN) == 0


def test_marks_left_by_a_compaction_that_died_change_nothing(spark, store, monkeypatch):
    for n in range(1, 4):
        store.commit(EXTRACT, n, f"a{n}", 10 * n, n)
    monkeypatch.setattr(type(store), "_drop_eras", lambda *_: None)
    monkeypatch.setattr("chatlake.sources.store.COMPACT_AFTER", 1)
    store.commit(EXTRACT, 4, "a4", 40, 4)
    monkeypatch.undo()
    assert store._eras(EXTRACT) == [0, 1]
    store.commit(EXTRACT, 2, "b2", 20, 2)
    assert {r.attempt for r in store.progress(EXTRACT).collect()} == {"a1", "b2", "a3", "a4"}
    assert store.mark(EXTRACT) == 20
