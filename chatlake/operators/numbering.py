"""Exact row numbers and neighbour windows that survive one huge group.

A window over a key puts each group into one task. That is right for ordinary groups and
the cheapest plan (one shuffle), but a single chat may hold a third of all rows. Groups
above `HOT_ROWS` are therefore numbered from a range-partitioned sort, which cuts them into
even pieces, and windows that look at neighbours work on blocks of consecutive positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from chatlake.functions.clock import integer_div
from chatlake.session import stored

HOT_ROWS = 1_000_000
BLOCK_ROWS = 100_000

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row in partition below


def number_rows(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    position: str = "position",
    total: str | None = None,
    sizes: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the 0-based `position` of each row within `key`, and the group size as `total`.

    `order` has to end in a column that makes it unique within the key. `sizes` may name a
    narrower frame with at least as many rows per key, to make the check for hot keys
    cheaper; by default `rows` itself is counted. That check is one aggregation, run when
    this function is called.
    """
    counted = (sizes if sizes is not None else rows).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counted.filter(F.col("_n") > hot_rows).select(key)
    if hot.isEmpty():
        return _number_by_window(rows, key, order, position, total)

    # At most (all rows / hot_rows) keys, so the set is small enough to broadcast.
    # The rows are stored too: three readers, one of which samples them, would compute them each.
    hot, rows = stored(hot), stored(rows)
    cold_rows = rows.join(F.broadcast(hot), key, "left_anti")
    hot_rows_only = rows.join(F.broadcast(hot), key, "left_semi")
    return _number_by_window(cold_rows, key, order, position, total).unionByName(
        _number_by_sort(hot_rows_only, key, order, position, total)
    )


def _number_by_window(rows, key, order, position, total):
    group = Window.partitionBy(key)
    numbered = {position: F.row_number().over(group.orderBy(*order)).cast("long") - 1}
    if total:
        numbered[total] = F.count(F.lit(1)).over(group)
    return rows.select("*", *[column.alias(name) for name, column in numbered.items()])


def _number_by_sort(rows, key, order, position, total):
    """Sort by (key, order), then shift each partition's row numbers by what precedes it.

    The sorted rows are stored because both uses below must see the same partition bounds,
    also after a lost executor.
    """
    row_id = F.col("_row")
    piece = F.shiftright(row_id, _ROW_BITS)
    ordered = stored(
        rows.orderBy(key, *order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_piece", piece)
    )
    spans = ordered.groupBy(key, "_piece").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    # One row per (partition, key that touches it): bounded by partitions + hot keys.
    earlier = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        key,
        "_piece",
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(key)).alias("_total"),
    )
    numbered = {position: F.col("_row") - F.col("_first") + F.col("_before")}
    if total:
        numbered[total] = F.col("_total")
    return ordered.join(F.broadcast(spans), [key, "_piece"]).select(
        *rows.columns, *[column.alias(name) for name, column in numbered.items()]
    )


def neighbour_blocks(
    rows: DataFrame, position: str, lookback: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Copy each row into its block of positions, and a block's tail also into the next one.

    Inside a `block` every row that belongs there finds its `lookback` predecessors;
    `is_own` is false for the copies, which are to be dropped after the window.
    """
    if lookback >= block_rows:
        raise ValueError("a block must be longer than the lookback")
    own = integer_div(F.col(position), block_rows)
    in_tail = F.col(position) % block_rows >= block_rows - lookback
    blocks = F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own))
    return rows.withColumn("block", F.explode(blocks)).withColumn("is_own", F.col("block") == own)


def block_window(position: str, *key: str) -> WindowSpec:
    """Window over one block; with `key` leading, rows already hashed by key stay put."""
    return Window.partitionBy(*key, "block").orderBy(position)


def previous(column: str, window: WindowSpec, steps: int = 1) -> Column:
    return F.lag(column, steps).over(window)
