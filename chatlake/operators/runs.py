"""Runs of consecutive messages of one chat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from chatlake.functions.clock import integer_div
from chatlake.operators.numbering import (
    BLOCK_ROWS,
    HOT_ROWS,
    block_window,
    neighbour_blocks,
    number_rows,
    previous,
)


def mark_runs(
    messages: DataFrame,
    order: Sequence[str],
    key: str = "chat_id",
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add `run_index`: it grows whenever `key` differs from the row before, in `order`.

    The order runs over the whole table, so rows get a global position first; changes are
    then found within blocks of positions and summed up over the blocks' totals.
    """
    everything = messages.withColumn("_all", F.lit(0))
    sizes = messages.select(F.lit(0).alias("_all"))
    placed = number_rows(everything, "_all", order, "_position", sizes=sizes, hot_rows=hot_rows)

    window = block_window("_position")
    before = previous(key, window)
    starts = (F.col("_position") == 0) | ~before.eqNullSafe(F.col(key))
    flagged = (
        neighbour_blocks(placed, "_position", 1, block_rows)
        .withColumn("_starts", starts.cast("int"))
        .filter("is_own")
    )
    # One row per block of `block_rows` messages, and one per stretch of `block_rows` blocks.
    totals = (
        flagged.groupBy("block")
        .agg(F.sum("_starts").alias("_n"))
        .withColumn("_stretch", integer_div(F.col("block"), block_rows))
    )
    stretches = totals.groupBy("_stretch").agg(F.sum("_n").alias("_n"))
    ahead = stretches.select("_stretch", _sum_before(Window.orderBy("_stretch")).alias("_ahead"))
    inside = _sum_before(Window.partitionBy("_stretch").orderBy("block"))
    offsets = (
        totals.select("block", "_stretch", inside.alias("_within"))
        .join(ahead, "_stretch")
        .select("block", (F.col("_ahead") + F.col("_within")).alias("_before"))
    )

    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    return (
        flagged.withColumn("_inside", F.sum("_starts").over(so_far))
        .join(offsets, "block")
        .select(*messages.columns, (F.col("_before") + F.col("_inside") - 1).alias("run_index"))
    )


def _sum_before(window: WindowSpec) -> Column:
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(earlier), F.lit(0))


def conversation_runs(
    messages: DataFrame,
    order: Sequence[str] = ("timestamp", "message_id"),
    key: str = "chat_id",
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per run: its chat, number of messages and first and last time."""
    marked = mark_runs(messages, order, key, hot_rows, block_rows)
    return marked.groupBy("run_index", key).agg(
        F.count(F.lit(1)).alias("message_count"),
        F.min(order[0]).alias("first_" + order[0]),
        F.max(order[0]).alias("last_" + order[0]),
    )
