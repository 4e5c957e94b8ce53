"""Key constraint on message ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.functions.clock import integer_div

#: Pieces of an id range that are looked at, and runs of ids made of them at most.
PIECES, MOST_RUNS = 4096, 64


class DuplicateMessageError(ValueError):
    """A batch holds a message id twice, or one that is stored already."""


def duplicate_ids(rows: DataFrame, key: str = "message_id") -> DataFrame:
    """Ids that occur more than once, with their number of rows."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def ids_already_stored(batch: DataFrame, stored: DataFrame, key: str = "message_id") -> DataFrame:
    """Stored ids that the batch holds too."""
    return stored.select(key).join(batch.select(key), key, "left_semi")


def id_runs(ids: DataFrame, key: str = "message_id", most: int = MOST_RUNS) -> list[tuple[int, int]]:
    """At most `most` ranges that hold all ids, with the widest gaps between them left out.

    Ids are counted in equal pieces of their range, so what the driver gets has a fixed size. Ids that fill
    their range are one run and need no second look.
    """
    low, high, count = ids.agg(F.min(key), F.max(key), F.count(key)).first()
    if not count:
        return []
    if high - low < 2 * count:
        return [(low, high)]
    width = (high - low) // PIECES + 1
    pieces = ids.groupBy(integer_div(F.col(key) - F.lit(low), width).alias("piece")).agg(F.min(key), F.max(key))
    ends = sorted((row[1], row[2]) for row in pieces.collect() if row[1] is not None)
    gaps = sorted(range(1, len(ends)), key=lambda at: ends[at - 1][1] - ends[at][0])[: most - 1]
    cuts = [0, *sorted(gaps), len(ends)]
    return [(ends[first][0], ends[last - 1][1]) for first, last in zip(cuts, cuts[1:])]


def in_runs(key: Column, runs: list[tuple[int, int]]) -> Column:
    """Whether an id lies in one of the runs, as literals that reach a scan's statistics."""
    return reduce(lambda a, b: a | b, [key.between(*run) for run in runs], F.lit(False))
