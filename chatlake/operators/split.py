"""Exact, reproducible train and validation split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatlake.session import stored

BUCKET_DIGITS = 4  # leading hex digits of the hash: 65,536 buckets


def shuffle_key(identifier: Column, seed: int) -> Column:
    """Hash that puts ids in a fixed random order for a seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), identifier))


def first_validation_key(
    ids: DataFrame,
    val_ratio: float = 0.1,
    seed: int = 42,
    identifier: str = "conversation_id",
    bucket_digits: int = BUCKET_DIGITS,
) -> Column:
    """The `(hash, id)` at the cut, or null when everything is for training.

    `ids` holds each id once. Instead of ordering all ids in one task, hash buckets are
    counted, and only the bucket with the cut is ordered. The cut is `n * (1 - ratio)` in
    double arithmetic, truncated.
    """
    key = shuffle_key(F.col(identifier), seed)
    keyed = ids.select(
        F.struct(key.alias("hash"), F.col(identifier).alias("id")).alias("key"),
        F.substring(key, 1, bucket_digits).alias("bucket"),
    )
    counts = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    up_to = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    train_size = (F.col("all") * F.lit(float(1 - val_ratio))).cast("long")
    located = (
        counts.select(
            "bucket",
            "n",
            F.sum("n").over(up_to).alias("reached"),
            F.sum("n").over(everything).alias("all"),
        )
        .withColumn("offset", train_size - (F.col("reached") - F.col("n")))
        .filter((F.col("offset") >= 0) & (F.col("offset") < F.col("n")))
    )
    cut = located.select(F.struct("bucket", "offset").alias("cut")).scalar()
    in_order = Window.partitionBy("bucket").orderBy("key")
    return (
        keyed.filter(F.col("bucket") == cut["bucket"])
        .withColumn("rank", F.row_number().over(in_order))
        .filter(F.col("rank") == cut["offset"] + 1)
        .select("key")
        .scalar()
    )


def split_label(boundary: Column, seed: int = 42, identifier: str = "conversation_id") -> Column:
    """`train` before the boundary, `validation` from it on."""
    key = F.struct(
        shuffle_key(F.col(identifier), seed).alias("hash"), F.col(identifier).alias("id")
    )
    return F.when(boundary.isNull() | (key < boundary), F.lit("train")).otherwise(
        F.lit("validation")
    )


def assign_split(
    rows: DataFrame,
    ids: DataFrame,
    val_ratio: float = 0.1,
    seed: int = 42,
    identifier: str = "conversation_id",
) -> DataFrame:
    """Add `split` to rows; all rows of one id land on the same side."""
    boundary = first_validation_key(ids, val_ratio, seed, identifier)
    return rows.withColumn("split", split_label(boundary, seed, identifier))


def split_once(
    ids: DataFrame, val_ratio: float = 0.1, seed: int = 42, identifier: str = "conversation_id"
) -> DataFrame:
    """`ids`, each once, with `split`. They are stored, so that what they come from is computed once and
    the counts, the cut and the labels all read one narrow table."""
    ids = stored(ids)
    return assign_split(ids, ids, val_ratio, seed, identifier)


def split_sizes(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("split").agg(F.count(F.lit(1)).alias("examples"))


def dataset_metadata(
    sizes: DataFrame, min_messages: int = 3, val_ratio: float = 0.1, seed: int = 42
) -> DataFrame:
    """One row: all conversations, and the examples in train and validation.

    `sizes` is `conversation_id, message_count`.
    """
    eligible = F.col("message_count") >= min_messages
    labelled = assign_split(sizes, sizes.filter(eligible), val_ratio, seed)
    return labelled.agg(
        F.count(F.lit(1)).alias("num_conversations"),
        F.count_if(eligible).alias("num_examples"),
        F.count_if(eligible & (F.col("split") == "train")).alias("num_training_examples"),
        F.count_if(eligible & (F.col("split") == "validation")).alias("num_validation_examples"),
    )
