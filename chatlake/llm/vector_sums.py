"""Sums of long vectors that tasks hold in part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import stored

ARITY = 16


def tree_summed(partial: DataFrame, dtype: str) -> DataFrame:
    """`key, vector`: the sum of each key's vectors in `partial(key long, node long, vector binary)`.

    Vectors are little-endian numbers of `dtype`, equally long for a key. Nodes are summed sixteen at a
    time, level by level and in their order, so a group is sixteen vectors at most whatever
    the number of tasks, and floating sums come out the same in every run. A node may come once a key.
    """

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        total = np.frombuffer(table.column("vector")[0].as_py(), dtype).copy()
        for vector in table.column("vector")[1:]:
            total += np.frombuffer(vector.as_py(), dtype)
        return pa.table(
            {
                "key": table.column("key").slice(0, 1),
                "node": pa.array([table.column("node")[0].as_py() // ARITY], pa.int64()),
                "vector": pa.array([total.tobytes()], pa.binary()),
            }
        )

    partial = stored(partial)
    last = partial.agg(F.max("node")).first()[0] or 0
    while last:
        groups = partial.groupBy("key", F.shiftright("node", ARITY.bit_length() - 1).alias("up"))
        partial = groups.applyInArrow(lambda table: add(table), "key long, node long, vector binary")
        last //= ARITY
    return partial.select("key", "vector")
