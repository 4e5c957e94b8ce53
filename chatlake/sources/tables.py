"""The four source tables: message, chat, handle and the chat-message link."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake import schemas

SOURCE_SCHEMAS = {
    "message": schemas.MESSAGE,
    "chat": schemas.CHAT,
    "handle": schemas.HANDLE,
    "chat_message_join": schemas.LINK,
}


@dataclass(frozen=True)
class ChatSource:
    message: DataFrame
    chat: DataFrame
    handle: DataFrame
    link: DataFrame


def _source(frames: dict[str, DataFrame]) -> ChatSource:
    return ChatSource(
        message=frames["message"],
        chat=frames["chat"],
        handle=frames["handle"],
        link=frames["chat_message_join"],
    )


def conform(frame: DataFrame, table: str) -> DataFrame:
    """Keep the columns the operators use, with their types; `ROWID` becomes `row_id`."""
    present = {name.lower(): name for name in frame.columns}
    columns = []
    for field in SOURCE_SCHEMAS[table]:
        name = present.get(field.name.lower())
        if name is None and field.name == "row_id":
            name = present.get("rowid")
        if name is None:
            raise ValueError(f"table {table} has no column {field.name}")
        columns.append(F.col(f"`{name}`").cast(field.dataType).alias(field.name))
    return frame.select(*columns)


@dataclass(frozen=True)
class Snapshot:
    """The state of a growing source at one moment, as the highest ids there were.

    Ids grow, and a message is written together with its link or after it. Then everything at or below
    these bounds is complete, and what is appended later lies above them.
    """

    message: int
    chat: int
    handle: int

    def of(self, source: ChatSource) -> ChatSource:
        """The source as it was: literal bounds, which reach the scans of all four tables."""
        return ChatSource(
            message=source.message.filter(F.col("row_id") <= F.lit(self.message)),
            chat=source.chat.filter(F.col("row_id") <= F.lit(self.chat)),
            handle=source.handle.filter(F.col("row_id") <= F.lit(self.handle)),
            link=source.link.filter(
                (F.col("message_id") <= F.lit(self.message)) & (F.col("chat_id") <= F.lit(self.chat))
            ),
        )


#: The bound of a table without rows: below every id.
NO_ROWS = -(1 << 63)


def take_snapshot(source: ChatSource) -> Snapshot:
    """The bounds of this moment, from one job over the id columns."""
    tables = {"message": source.message, "chat": source.chat, "handle": source.handle}
    highest = [
        frame.agg(F.coalesce(F.max("row_id"), F.lit(NO_ROWS)).alias("highest")).select(F.lit(name).alias("name"), "highest")
        for name, frame in tables.items()
    ]
    return Snapshot(**{row.name: row.highest for row in reduce(DataFrame.unionAll, highest).collect()})


def read_source(
    spark: SparkSession, root: str, file_format: str = "parquet", snapshot: Snapshot | None = None
) -> ChatSource:
    """Source tables stored as folders `message`, `chat`, `handle`, `chat_message_join`.

    With a `snapshot` the tables are read as they were when it was taken.
    """
    found = _source(
        {
            table: spark.read.schema(schema).format(file_format).load(f"{root}/{table}")
            for table, schema in SOURCE_SCHEMAS.items()
        }
    )
    return snapshot.of(found) if snapshot else found


def source_from_catalog(
    spark: SparkSession, database: str, snapshot: Snapshot | None = None
) -> ChatSource:
    """Source tables registered in the catalog; `snapshot` as in `read_source`."""
    found = _source(
        {table: conform(spark.table(f"{database}.{table}"), table) for table in SOURCE_SCHEMAS}
    )
    return snapshot.of(found) if snapshot else found


def source_from_jdbc(
    spark: SparkSession,
    url: str,
    partitions: int = 64,
    after: int | None = None,
    snapshot: Snapshot | None = None,
    **options: str,
) -> ChatSource:
    """Source tables of a database the user has a driver for, as of one moment.

    The bounds of all four tables come from one statement, which the database answers from one state.
    Every read then carries its bound, so rows written meanwhile do not show. Rows are read in
    `partitions` ranges of their row number, messages above `after`, a progress mark, only. A
    `snapshot` taken earlier lowers the bounds. `options` go to the JDBC reader, e.g. `driver`.
    """

    def reader(query: str):
        named = f"({query}) AS source_rows"
        return spark.read.format("jdbc").options(url=url, dbtable=named, **options)

    columns = [
        f"(SELECT {end}(ROWID) FROM {table}) AS {table}_{end}" for table in SOURCE_SCHEMAS for end in ("min", "max")
    ]
    found = reader(f"SELECT {', '.join(columns)}").load().first()
    low = {table: _or_no_rows(found[f"{table}_min"]) for table in SOURCE_SCHEMAS}
    high = {table: _or_no_rows(found[f"{table}_max"]) for table in SOURCE_SCHEMAS}
    for table in ("message", "chat", "handle") if snapshot else ():
        high[table] = min(high[table], getattr(snapshot, table))
    where = {table: [f"ROWID <= {bound}"] for table, bound in high.items()}
    where["chat_message_join"] += [f"message_id <= {high['message']}", f"chat_id <= {high['chat']}"]
    if after is not None:
        low["message"] = max(low["message"], after + 1)
        where["message"].append(f"ROWID > {after}")
        where["chat_message_join"].append(f"message_id > {after}")

    frames = {}
    for table, schema in SOURCE_SCHEMAS.items():
        names = [f.name for f in schema if f.name != "row_id"]
        own = " AND ".join(where[table])
        rows = reader(f"SELECT ROWID AS row_id, {', '.join(names)} FROM {table} WHERE {own}")
        if low[table] < high[table]:
            rows = rows.options(
                partitionColumn="row_id",
                lowerBound=str(low[table]),
                upperBound=str(high[table]),
                numPartitions=str(partitions),
            )
        frames[table] = conform(rows.load(), table)
    return _source(frames)


def _or_no_rows(bound: int | None) -> int:
    return NO_ROWS if bound is None else bound


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    names = [(table.name,) for table in spark.catalog.listTables(database)]
    return spark.createDataFrame(names, "table_name string")


def list_columns(spark: SparkSession, table: str) -> DataFrame:
    columns = [(column.name, column.dataType) for column in spark.catalog.listColumns(table)]
    return spark.createDataFrame(columns, "column_name string, data_type string")
