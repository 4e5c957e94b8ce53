"""Time the jobs on a replicated source in which one chat holds a third of all messages.

    python bench_jobs.py FOLDER COPIES WORK_FOLDER

The source is FOLDER's derived tables, COPIES times with shifted ids, plus a busy chat made
of the same messages. Prints one JSON line with seconds and rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from chatlake.operators import export as ex
from chatlake.operators.extract import extract
from chatlake.plans.jobs import run_clean, run_export, run_extract, run_prepare
from chatlake.session import build_session
from chatlake.sources.derived import derived_source
from chatlake.sources.store import CLEAN, MessageStore
from chatlake.sources.tables import read_source

ID_SHIFT, CHAT_SHIFT = 10_000_000, 1_000_000


def replicate(spark, folder: str, copies: int, target: str) -> None:
    source = derived_source(spark, folder)
    busy = max(copies // 2, 1)  # copies whose messages all go to one chat
    copy = spark.range(copies + busy).withColumnRenamed("id", "copy")
    own_chats = F.col("copy") < copies

    def times(frame, copy_ids):
        return frame.join(F.broadcast(copy_ids))

    message = times(source.message, copy).select(
        (F.col("row_id") + F.col("copy") * ID_SHIFT).alias("row_id"),
        *[F.col(name) for name in source.message.columns if name != "row_id"],
    )
    link = times(source.link, copy).select(
        F.when(own_chats, F.col("chat_id") + F.col("copy") * CHAT_SHIFT)
        .otherwise(F.lit(1))
        .alias("chat_id"),
        (F.col("message_id") + F.col("copy") * ID_SHIFT).alias("message_id"),
    )
    chat = times(source.chat, copy.filter(own_chats)).select(
        (F.col("row_id") + F.col("copy") * CHAT_SHIFT).alias("row_id"), "room_name", "display_name"
    )
    tables = {
        "message": message,
        "chat": chat,
        "handle": source.handle,
        "chat_message_join": link,
    }
    for name, frame in tables.items():
        # Ordered by id like a log that grew, in files enough for all cores.
        order = "message_id" if name == "chat_message_join" else "row_id"
        frame.repartitionByRange(32, order).write.parquet(f"{target}/{name}")


def main(folder: str, copies: str, work: str) -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        app="chatlake-bench-jobs",
        master=f"local[{cpus}]",
        spark_sql_shuffle_partitions=str(4 * int(cpus)),
        spark_driver_memory="12g",
        spark_ui_enabled="false",
        spark_sql_warehouse_dir=f"{work}/warehouse",
        spark_checkpoint_dir=f"{work}/checkpoint",
    )
    spark.sparkContext.setLogLevel("ERROR")
    replicate(spark, folder, int(copies), f"{work}/source")
    source = read_source(spark, f"{work}/source")
    messages = source.message.count()
    store = MessageStore(spark, "bench_jobs", f"{work}/store")
    store.create()
    seconds, rows = {}, {}

    def timed(name, job):
        start = time.perf_counter()
        rows[name] = job()
        seconds[name] = round(time.perf_counter() - start, 2)

    def compute(frame):
        frame.write.format("noop").mode("overwrite").save()

    timed("extract_no_store", lambda: compute(extract(source)))
    timed("export_rows", lambda: compute(ex.export_messages(source)))
    timed("export_rows_hot", lambda: compute(ex.export_messages(source, hot_rows=100_000)))
    timed("extract", lambda: run_extract(source, store))
    timed("clean_hot", lambda: run_clean(store, hot_rows=int(os.environ.get("HOT_ROWS", 100_000))))
    timed("prepare", lambda: run_prepare(store.read(CLEAN), f"{work}/prepared"))
    timed("export", lambda: run_export(source, f"{work}/export", hot_rows=100_000) and None)
    print(json.dumps({"messages": messages, "seconds": seconds, "rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
