"""Stored tables, batches and progress marks.

Each run writes one partition (`batch_id`, `attempt`) and then commits it with a row in
`progress`. Readers see the newest committed attempt of each batch only. The batch id is the
mark the run started from, so a run that is repeated after a failure takes the place of the
failed one; until it is committed, what was committed before stays as it is.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake import schemas
from chatlake.operators.clean import chat_sizes
from chatlake.operators.keys import (
    DuplicateMessageError,
    duplicate_ids,
    id_runs,
    ids_already_stored,
    in_runs,
)

EXTRACT = "extract"
CLEAN = "clean"
WAIT = "wait"
UNLINKED = "unlinked"


@dataclass(frozen=True)
class Stage:
    name: str
    table: str


STAGES = {
    EXTRACT: Stage(EXTRACT, "messages"),
    CLEAN: Stage(CLEAN, "cleaned_messages"),
    WAIT: Stage(WAIT, "waiting_messages"),
    UNLINKED: Stage(UNLINKED, "unlinked_messages"),
}
_TOTALS = "chat_totals"
#: Commits of a stage after which its marks are put into one file.
COMPACT_AFTER = 64
#: The batch of a mark that was taken over from elsewhere; it has no rows.
_IMPORTED = -1
_TABLE_SCHEMAS = {
    "messages": schemas.EXTRACTED,
    "cleaned_messages": schemas.CLEANED,
    "waiting_messages": schemas.WAITING,
    "unlinked_messages": schemas.MESSAGE,
    _TOTALS: schemas.CHAT_SIZES,
}


def latest_mark(status: DataFrame, stage: Column | None = None) -> DataFrame:
    """One row `last_id`: the newest mark by time, 0 when there is none."""
    if stage is not None:
        status = status.filter(stage)
    newest = F.max_by("last_id", F.struct("updated_at", "last_id"))
    return status.agg(F.coalesce(newest, F.lit(0)).alias("last_id"))


def latest_marks(status: DataFrame) -> DataFrame:
    """The newest mark of each stage."""
    newest = F.max_by("last_id", F.struct("updated_at", "last_id"))
    return status.groupBy("stage").agg(newest.alias("last_id"))


def decode_legacy_mark(mark: Column) -> Column:
    """Integer from little-endian bytes, the way older status tables hold it."""
    positions = F.sequence(F.length(mark), F.lit(1), F.lit(-1))
    filled = F.when(F.length(mark) > 0, positions).otherwise(F.array().cast("array<int>"))

    def add_byte(value: Column, position: Column) -> Column:
        digit = F.conv(F.hex(F.substring(mark, position, F.lit(1))), 16, 10).cast("long")
        return value * 256 + digit

    return F.aggregate(filled, F.lit(0).cast("long"), add_byte)


class MessageStore:
    """The tables of one database; `location` puts a new database into a given folder."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark = spark
        self.database = database
        self.location = location

    def on(self, spark: SparkSession) -> MessageStore:
        """The same tables seen from another session, e.g. that of a micro-batch."""
        return MessageStore(spark, self.database, self.location)

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def create(self) -> None:
        """Create database and tables that are not there yet."""
        if self.location:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.location}'"
            )
        else:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        for table, schema in _TABLE_SCHEMAS.items():
            self._create_table(table, schema, {"batch_id": "BIGINT", "attempt": "STRING"})
        self._create_table("progress", schemas.PROGRESS, {"stage": "STRING", "era": "BIGINT"})

    def _create_table(self, table, schema, partition):
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
        columns += [f"{name} {kind}" for name, kind in partition.items()]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name(table)} ({', '.join(columns)}) "
            f"USING parquet PARTITIONED BY ({', '.join(partition)})"
        )

    def reset(self, include_raw: bool = False) -> None:
        """Forget the cleaned rows, with `include_raw` also the extracted and the waiting ones."""
        self.create()
        for stage in STAGES.values():
            if stage.name != CLEAN and not include_raw:
                continue
            self._drop_eras(stage.name, self._eras(stage.name))
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(stage.table)}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(_TOTALS)}")
        self.create()

    def _table(self, table: str) -> DataFrame:
        """The table as it is now, also when another session wrote to it."""
        self.spark.catalog.refreshTable(self._name(table))
        return self.spark.table(self._name(table))

    def progress(self, stage: str) -> DataFrame:
        """The valid row of each batch, which is its newest."""
        columns = [name for name in schemas.PROGRESS.fieldNames() if name != "batch_id"]
        newest = F.max_by(F.struct(*columns), F.struct("updated_at", "attempt"))
        rows = self._table("progress").filter(F.col("stage") == stage)
        return rows.groupBy("batch_id").agg(newest.alias("_")).select("batch_id", "_.*")

    def _eras(self, stage: str) -> list[int]:
        """Partitions of the stage's marks: one, or two while it is being compacted."""
        shown = self.spark.sql(f"SHOW PARTITIONS {self._name('progress')} PARTITION (stage = '{stage}')")
        return sorted(int(row["partition"].rsplit("=", 1)[1]) for row in shown.collect())

    def _drop_eras(self, stage: str, eras: list[int]) -> None:
        for era in eras:
            self.spark.sql(
                f"ALTER TABLE {self._name('progress')} "
                f"DROP IF EXISTS PARTITION (stage = '{stage}', era = {era})"
            )

    def _compact_progress(self, stage: str, era: int) -> None:
        """Copy the valid marks into the next era, as one file, and drop the eras before it.

        A run that dies in between leaves marks twice, which changes nothing: the newest of a batch is valid.
        """
        if self._table("progress").filter((F.col("stage") == stage) & (F.col("era") == era)).count() <= COMPACT_AFTER:
            return
        marks = self.progress(stage).select(*schemas.PROGRESS.fieldNames(), F.lit(stage), F.lit(era + 1).cast("long"))
        marks.coalesce(1).write.insertInto(f"{self.database}.progress")
        self._drop_eras(stage, [old for old in self._eras(stage) if old <= era])

    def mark(self, stage: str) -> int:
        return latest_mark(self.progress(stage)).first()["last_id"]

    def read(self, stage: str, after: int | None = None) -> DataFrame:
        """Committed rows of a stage; `after` leaves out batches that end at or below it."""
        return self._committed(self._table(STAGES[stage].table), stage, after)

    def import_mark(self, stage: str, status: DataFrame) -> int:
        """Go on behind the newest mark of an older status table; returns that mark.

        `status` has `last_id`, as a number or as little-endian bytes, and `updated_at`.
        """
        last_id = F.col("last_id")
        if dict(status.dtypes)["last_id"] == "binary":
            last_id = decode_legacy_mark(last_id)
        mark = latest_mark(status.select(last_id.cast("long").alias("last_id"), "updated_at"))
        found = mark.first()["last_id"]
        self.commit(stage, _IMPORTED, "imported", found, 0)
        return found

    def read_batch(self, stage: str, batch_id: int, attempt: str) -> DataFrame:
        """Rows of one attempt at a batch, committed or not."""
        is_attempt = (F.col("batch_id") == batch_id) & (F.col("attempt") == attempt)
        return self._table(STAGES[stage].table).filter(is_attempt).drop("attempt")

    def _committed(self, table, stage, after=None):
        batches = self.progress(stage)
        if after is not None:
            batches = batches.filter(F.col("last_id") > after)
        valid = batches.select("batch_id", "attempt")
        return table.join(valid, ["batch_id", "attempt"], "left_semi").drop("attempt")

    def sizes_before(self, batch_id: int) -> DataFrame:
        """Cleaned rows of each chat in the committed batches other than this one.

        Each batch leaves the totals as they are after it, so going on with an index reads one row
        for each chat, however many batches there were.
        """
        found = self._newest_batches(CLEAN, 1, but=batch_id)
        is_last = F.lit(False)
        for row in found:
            is_last = (F.col("batch_id") == row["batch_id"]) & (F.col("attempt") == row["attempt"])
        return self._table(_TOTALS).filter(is_last).drop("batch_id", "attempt")

    def _newest_batches(self, stage: str, count: int, but: int | None = None) -> list:
        """Ids and attempts of the batches committed last."""
        batches = self.progress(stage).filter(F.col("batch_id") != _IMPORTED)
        if but is not None:
            batches = batches.filter(F.col("batch_id") != but)
        newest = batches.orderBy(F.desc("updated_at"), F.desc("attempt"))
        return newest.limit(count).select("batch_id", "attempt").collect()

    def write_batch(self, stage: str, rows: DataFrame, batch_id: int) -> str:
        """Write an attempt at a batch, check its keys and return the attempt's name."""
        attempt = uuid.uuid4().hex
        # Ids in order within each file keep its statistics narrow for mark and key filters.
        ordered = rows.sortWithinPartitions("message_id")
        self._write(STAGES[stage].table, ordered, batch_id, attempt)
        self._check_keys(stage, batch_id, attempt)
        if stage == CLEAN:
            own = chat_sizes(self.read_batch(CLEAN, batch_id, attempt))
            totals = own.unionByName(self.sizes_before(batch_id)).groupBy("chat_id")
            summed = totals.agg(F.sum("message_count").alias("message_count"))
            self._write(_TOTALS, summed, batch_id, attempt)
        return attempt

    def _write(self, table, rows, batch_id, attempt):
        self.spark.sql(
            f"INSERT INTO {self._name(table)} "
            f"PARTITION (batch_id = {int(batch_id)}, attempt = '{attempt}') "
            "SELECT * FROM {rows}",
            rows=rows.select(*_TABLE_SCHEMAS[table].fieldNames()),
        )

    def waiting_before(self, batch_id: int) -> DataFrame:
        """Messages whose chat was not listed when the last batch before this one was committed."""
        found = self._last_waiting(batch_id)
        return self.read_batch(WAIT, found["batch_id"] or 0, found["attempt"] or "").drop("batch_id")

    def _last_waiting(self, batch_id: int):
        earlier = self.progress(WAIT).filter(F.col("batch_id") < batch_id)
        last = F.max_by(F.struct("batch_id", "attempt", "row_count"), "batch_id")
        return earlier.agg(last.alias("_")).select("_.*").first()

    def replace_waiting(self, messages: DataFrame, batch_id: int) -> None:
        """Keep `messages` for the next batch, instead of those that were kept before.

        Nothing is written while there is nothing to keep.
        """
        replayed = not self.progress(WAIT).filter(F.col("batch_id") == batch_id).isEmpty()
        if not replayed and not self._last_waiting(batch_id)["row_count"] and messages.isEmpty():
            return
        self._replace(WAIT, messages, batch_id)
        # The batch before stays, for a replay of this one.
        for older in self._newest_batches(WAIT, 3)[2:]:
            self.drop_attempt(WAIT, older["batch_id"], older["attempt"])

    def add_unlinked(self, messages: DataFrame, batch_id: int) -> None:
        """Keep messages of a batch that got no link in time."""
        replayed = not self.progress(UNLINKED).filter(F.col("batch_id") == batch_id).isEmpty()
        if replayed or not messages.isEmpty():
            self._replace(UNLINKED, messages, batch_id)

    def _replace(self, stage: str, messages: DataFrame, batch_id: int) -> None:
        attempt = uuid.uuid4().hex
        self._write(STAGES[stage].table, messages, batch_id, attempt)
        row_count = self.read_batch(stage, batch_id, attempt).count()
        self.commit(stage, batch_id, attempt, 0, row_count)

    def _check_keys(self, stage, batch_id, attempt):
        batch = self.read_batch(stage, batch_id, attempt)
        repeated = duplicate_ids(batch).select("message_id").limit(5)
        known = ids_already_stored(batch, self._stored_near(stage, batch, batch_id)).limit(5)
        found = [row["message_id"] for row in repeated.union(known).take(5)]
        if found:
            self.drop_attempt(stage, batch_id, attempt)
            raise DuplicateMessageError(f"message ids repeated in {stage} batch: {found}")

    def _stored_near(self, stage: str, ids: DataFrame, batch_id: int) -> DataFrame:
        """Rows of other batches whose ids lie in the runs of the given ids.

        The runs are literals, so a late low id opens the stored files around it, and not all between it and
        the others.
        """
        runs = id_runs(ids)
        others = self.read(stage, after=runs[0][0] - 1 if runs else None)
        return others.filter((F.col("batch_id") != batch_id) & in_runs(F.col("message_id"), runs))

    def drop_attempt(self, stage: str, batch_id: int, attempt: str) -> None:
        for table in self._tables(stage):
            self._drop_partition(table, batch_id, attempt)

    def _tables(self, stage: str) -> tuple[str, ...]:
        return (STAGES[stage].table, _TOTALS) if stage == CLEAN else (STAGES[stage].table,)

    def _drop_partition(self, table: str, batch_id: int, attempt: str) -> None:
        self.spark.sql(
            f"ALTER TABLE {self._name(table)} "
            f"DROP IF EXISTS PARTITION (batch_id = {int(batch_id)}, attempt = '{attempt}')"
        )

    def _drop_other_attempts(self, table: str, batch_id: int, attempt: str) -> None:
        """Drop what earlier attempts at a batch left; only the batch's own partitions are listed."""
        found = self.spark.sql(f"SHOW PARTITIONS {self._name(table)} PARTITION (batch_id = {int(batch_id)})")
        for row in found.collect():
            other = row["partition"].rsplit("=", 1)[1]
            if other != attempt:
                self._drop_partition(table, batch_id, other)

    def batch_summary(self, stage: str, batch_id: int, attempt: str) -> tuple[int, int | None]:
        """Rows and highest id of a written attempt."""
        row = (
            self.read_batch(stage, batch_id, attempt)
            .agg(F.count(F.lit(1)).alias("n"), F.max("message_id").alias("last"))
            .first()
        )
        return row["n"], row["last"]

    def commit(
        self, stage: str, batch_id: int, attempt: str, last_id: int, row_count: int
    ) -> None:
        """Append the mark, which makes the attempt visible; other attempts at the batch go."""
        era = max(self._eras(stage), default=0)
        row = self.spark.range(1).select(
            F.lit(int(batch_id)).cast("long").alias("batch_id"),
            F.lit(attempt).alias("attempt"),
            F.lit(int(last_id)).cast("long").alias("last_id"),
            F.lit(int(row_count)).cast("long").alias("row_count"),
            F.current_timestamp().alias("updated_at"),
            F.lit(stage).alias("stage"),
            F.lit(era).cast("long").alias("era"),
        )
        row.write.insertInto(f"{self.database}.progress")
        self._compact_progress(stage, era)
        for table in self._tables(stage) if batch_id != _IMPORTED else ():
            self._drop_other_attempts(table, batch_id, attempt)
        if stage == CLEAN:
            # The totals before this batch stay, for a replay of it.
            for older in self._newest_batches(CLEAN, 3)[2:]:
                self._drop_partition(_TOTALS, older["batch_id"], older["attempt"])
