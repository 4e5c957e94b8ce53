"""Connected components of an edge table, by alternating large and small stars.

Each round is two aggregations and two joins on narrow rows. No neighbour list is ever
collected: a node's smallest neighbour is an aggregate, which Spark combines before the
shuffle, and it goes back to the edges by a join of two stored tables, whose skewed
partitions adaptive execution can split. Every step is stored, so a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import discard, stored

MAX_ROUNDS = 100


def _signature(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    out = stored(
        both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    )
    discard(least)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked to the smallest. Needs a > b."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")))
    ends = F.array(F.col("a"), F.col("b"))
    out = stored(
        edges.join(least, "a")
        .select(F.explode(ends).alias("a"), F.col("m").alias("b"))
        .filter("a <> b")
        .distinct()
    )
    discard(least)
    return out


def connected_components(edges: DataFrame) -> DataFrame:
    """`(node, component)` for each node of `edges(a, b)`; component is its smallest node.

    Edges may repeat, run both ways or be loops; nodes are longs and not null. Nodes with
    loops only are left out, as are nodes without an edge.
    """
    now = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _signature(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        large = _large_star(now)
        small = _small_star(large)
        discard(now, large)
        now, last = small, before
        before = _signature(now)
        if before == last:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.groupBy("b").agg(F.lit(1).alias("_")).select("b", F.col("b").alias("c"))
    return stored(now.unionAll(roots).select(F.col("a").alias("node"), F.col("b").alias("component")))
