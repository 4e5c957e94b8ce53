"""Helpers that several of the operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.session import stored

__all__ = ["stored", "discard", "partitions", "read_table", "id_text", "words", "whole_groups", "mixed"]

#: Everything that is not ASCII white space: the words of `documents`.
WORD = "[^\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def discard(*frames: DataFrame) -> None:
    """Delete the files behind frames made by `stored` that no later result reads."""
    for frame in frames:
        for path in {re.sub(r"/[^/]*$", "", name) for name in frame.inputFiles()}:
            if not re.search(r"/stored-[0-9a-f]{32}$", path):
                raise ValueError(f"not a stored table: {path}")
            jvm = frame.sparkSession._jvm
            folder = jvm.org.apache.hadoop.fs.Path(path)
            conf = frame.sparkSession._jsparkSession.sessionState().newHadoopConf()
            folder.getFileSystem(conf).delete(folder, True)


def id_text(docs: DataFrame) -> DataFrame:
    """`doc_id` as long and `text` as string, without any other column."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Cut a stream of batches sorted by `key` so that no group is in two tables.

    What is held back is one group at most, so groups have to be bounded.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        changes = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            changes = np.concatenate([[0], changes])
        if not len(changes):
            held.append(batch)
            continue
        last = int(changes[-1])
        done = [*held, batch.slice(0, last)]
        held = [batch.slice(last)]
        yield pa.Table.from_batches(done)
    if held:
        yield pa.Table.from_batches(held)


def mixed(values: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit integers (two rounds of xor-shift and multiply)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
