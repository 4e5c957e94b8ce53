"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "chatlake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; `settings` override them.

    Keyword names use underscores for dots, e.g. ``spark_sql_shuffle_partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # One busy chat or contact may hold most of a join: let the split go ahead
        # even when it costs the next operator a shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.parquet.filterPushdown": "true",
        # Join state of the stream on the executors' disks instead of in their heaps.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
    overrides = {name.replace("_", "."): value for name, value in settings.items()}
    for name, value in {**defaults, **overrides}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def require_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; it has to be reachable from every
    executor, so a temporary folder is only made up for a local master.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="chatlake-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def stored(frame: DataFrame) -> DataFrame:
    """The rows as a table in the checkpoint folder, computed once and read from there.

    Like `checkpoint()`, but columnar: later steps read only the columns they need. Files
    stay until the folder is emptied.
    """
    path = f"{require_checkpoint_dir(frame.sparkSession)}/stored-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark knows; none is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    folder.getFileSystem(conf).delete(folder, True)
