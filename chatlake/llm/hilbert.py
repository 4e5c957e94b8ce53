"""Shards along a Hilbert curve through several metadata dimensions, in native expressions.

Each dimension is cut at its quantiles into 2^bits steps, so hot values do not leave the
curve empty elsewhere. The curve index of a row names its cell; rows of a cell are dealt to 4,096
leaves by a hash of their id, so that a cell holding a third of all rows is many small groups.
Row numbers along the curve come from counts: a tree of six-bit digits over the leaves, in which
each window holds at most 64 rows, and a window over each leaf. Runs of equal length are shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatlake.llm.common import discard, stored

BITS = 6
DIGIT = 6
LEAF_BITS = 12


def _step(value: Column, cuts: list, low: int = 0, high: int | None = None) -> Column:
    """How many cuts are not above the value, by a tree of comparisons."""
    high = len(cuts) if high is None else high
    if low == high:
        return F.lit(low).cast("long")
    middle = (low + high) // 2
    return F.when(value < F.lit(cuts[middle]), _step(value, cuts, low, middle)).otherwise(
        _step(value, cuts, middle + 1, high)
    )


def _let(value: Column, body) -> Column:
    """`body(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _moves(bits: range, n: int) -> Column:
    return F.array(
        *[
            F.struct(F.lit(1 << b).cast("long").alias("bit"), F.lit(axis).alias("axis"))
            for b in bits
            for axis in range(1, n + 1)
        ]
    )


def curve_index(steps: list[Column], bits: int) -> Column:
    """Hilbert index of a cell, most significant digit first.

    From the top bit down, every axis with the bit set inverts the lower bits of the first
    axis, and every other one swaps them with the first; Gray coding along the axes and over
    the bits follows, and the bits of all axes are interleaved.
    """
    n = len(steps)
    zero = F.lit(0).cast("long")

    def turned(axes: Column, move: Column) -> Column:
        bit, axis = move["bit"], move["axis"]
        low = bit - 1
        first, own = F.element_at(axes, 1), F.element_at(axes, axis)
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        is_set = own.bitwiseAND(bit) != 0
        return F.transform(
            axes,
            lambda x, i: F.when(is_set & (i == 0), x.bitwiseXOR(low))
            .when(~is_set & ((i == 0) | (i + 1 == axis)) & (axis != 1), x.bitwiseXOR(swap))
            .otherwise(x),
        )

    def gray(axes: Column) -> Column:
        return F.transform(
            axes, lambda x, i: F.aggregate(F.slice(axes, F.lit(1), i + 1), zero, lambda a, v: a.bitwiseXOR(v))
        )

    def flipped(axes: Column) -> Column:
        last = F.element_at(axes, n)
        flip = F.aggregate(
            _moves(range(bits - 1, 0, -1), 1),
            zero,
            lambda t, m: F.when(last.bitwiseAND(m["bit"]) != 0, t.bitwiseXOR(m["bit"] - 1)).otherwise(t),
        )
        return _let(flip, lambda f: F.transform(axes, lambda x: x.bitwiseXOR(f)))

    def interleaved(axes: Column) -> Column:
        return F.aggregate(
            _moves(range(bits - 1, -1, -1), n),
            zero,
            lambda t, m: t * 2 + F.when(F.element_at(axes, m["axis"]).bitwiseAND(m["bit"]) != 0, 1).otherwise(0),
        )

    start = F.array(*[s.cast("long") for s in steps])
    if bits > 1:
        start = F.aggregate(_moves(range(bits - 1, 0, -1), n), start, turned)
    return _let(start, lambda a: _let(gray(a), lambda g: _let(flipped(g), interleaved)))


def _string_cuts(rows: DataFrame, column: str, shares: list[float]) -> list[str | None]:
    """The values up to which these shares of all rows lie; nulls come first.

    Distinct values are counted and sorted, and the counts summed up within and over the sorted pieces,
    so whole strings are compared and no task holds more than a piece.
    """
    first = F.asc_nulls_first(column)
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ordered = stored(counted.orderBy(first).withColumn("piece", F.spark_partition_id()))
    over = Window.orderBy("piece")  # a row for each piece
    pieces = ordered.groupBy("piece").agg(F.sum("n").alias("own")).select(
        "piece",
        (F.sum("own").over(over) - F.col("own")).alias("before"),
        F.sum("own").over(Window.partitionBy()).alias("total"),
    )
    within = Window.partitionBy("piece").orderBy(first).rowsBetween(Window.unboundedPreceding, 0)
    reached = ordered.withColumn("within", F.sum("n").over(within)).join(F.broadcast(pieces), "piece")
    last = F.col("before") + F.col("within")
    here = F.filter(
        F.array(*map(F.lit, shares)),
        lambda share: (share * F.col("total") > last - F.col("n")) & (share * F.col("total") <= last),
    )
    found = reached.select(F.col(column).alias("value"), F.explode(here).alias("share")).collect()
    discard(ordered)
    return [row.value for row in sorted(found, key=lambda row: row.share)]


def with_curve(rows: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """`rows` with `curve`; dimensions are strings or numbers, nulls come first.

    The quantiles of numbers come from one aggregation, those of strings from counts of their values; what
    reaches the driver is 2^bits - 1 values for each dimension.
    """
    kinds = dict(rows.dtypes)
    shares = [i / 2**bits for i in range(1, 2**bits)]
    numbers = [d for d in dimensions if kinds[d] != "string"]
    value = {d: F.coalesce(F.col(d).cast("double"), F.lit(float("-inf"))) for d in numbers}
    cuts = {d: _string_cuts(rows, d, shares) for d in dimensions if d not in value}
    if numbers:
        quantiles = [F.percentile_approx(value[d], shares, 10000).alias(f"q{i}") for i, d in enumerate(numbers)]
        found = rows.agg(*quantiles).first()
        cuts |= {d: list(found[f"q{i}"] or []) for i, d in enumerate(numbers)}

    def step(d: str) -> Column:
        if d in value:
            return _step(value[d], cuts[d])
        # Cuts at null lie below all strings and not above null itself.
        known = [cut for cut in cuts[d] if cut is not None]
        own = F.when(F.col(d).isNull(), F.lit(0).cast("long")).otherwise(_step(F.col(d), known))
        return own + len(cuts[d]) - len(known)

    # The steps are fixed in a row of their own before the curve's expressions refer to them often.
    stepped = rows.withColumn("_steps", F.array(*map(step, dimensions)))
    return stepped.withColumn("curve", curve_index([F.col("_steps")[i] for i in range(len(dimensions))], bits)).drop("_steps")


def _packed(rows: DataFrame, dimensions: list[str]) -> tuple[DataFrame, list[str]]:
    """The rows as a struct `_row` beside their dimensions, so that no column can have a name that is used here."""
    names = [f"_d{i}" for i in range(len(dimensions))]
    own = [F.col(f"`{d}`").alias(n) for d, n in zip(dimensions, names)]
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), *own), names


def _offsets(counts: DataFrame, bits: int) -> DataFrame:
    """`(node, before)`: rows in front of each leaf of `counts(node, n)`."""
    levels = [counts]
    up = F.shiftright("node", DIGIT)
    for _ in range(0, bits, DIGIT):
        levels.append(levels[-1].groupBy(up.alias("node")).agg(F.sum("n").alias("n")))
    before = levels[-1].select("node", F.lit(0).cast("long").alias("before"))
    for level in reversed(levels[:-1]):
        inner = Window.partitionBy("parent").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        within = level.withColumn("parent", up).select(
            "node", "parent", F.coalesce(F.sum("n").over(inner), F.lit(0)).alias("within")
        )
        outer = before.select(F.col("node").alias("parent"), "before")
        before = within.join(outer, "parent").select("node", (F.col("before") + F.col("within")).alias("before"))
    return before


def hilbert_shards(
    rows: DataFrame, dimensions: list[str], shards: int = 16, id_column: str = "doc_id", bits: int = BITS
) -> DataFrame:
    """`rows` with `curve`, `shard` (0 to shards - 1) and `slot` (gapless from 0 in each shard).

    Shards are runs along the curve; their row counts differ by one at most. Rows are ordered by
    curve index, hash of id, id, and then by all other columns, so that only rows that are equal throughout are
    interchangeable. `rows` should be narrow: it is stored and shuffled. Null ids and null
    dimensions are ordinary values; no rows give no rows. Columns named curve, shard or slot are replaced;
    others may have any name.
    """
    packed, names = _packed(rows, dimensions)
    own_id = F.col("_row").getField(id_column)
    narrow = stored(packed.withColumn("_id", own_id))
    leaf = F.shiftleft("curve", LEAF_BITS) + F.xxhash64("_id").bitwiseAND(F.lit((1 << LEAF_BITS) - 1).cast("long"))
    placed = stored(with_curve(narrow, names, bits).withColumn("node", leaf))
    discard(narrow)
    counts = stored(placed.groupBy("node").agg(F.count(F.lit(1)).alias("n")))
    total = placed.count()
    before = stored(_offsets(counts, bits * len(dimensions) + LEAF_BITS))
    discard(counts)
    inner = Window.partitionBy("node").orderBy("_id", "_row")
    rank = F.row_number().over(inner).cast("long") - 1 + F.col("before")
    numbered = placed.join(before, "node").withColumn("_rank", rank)
    shard = F.expr(f"_rank * {shards} div {max(total, 1)}L")
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    kept = [F.col("_row").getField(c).alias(c) for c in rows.columns if c not in ("curve", "shard", "slot")]
    return (
        numbered.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("_rank") - first)
        .select(*kept, "curve", "shard", "slot")
    )


def write_shards(docs: DataFrame, dimensions: list[str], path: str, shards: int = 16) -> None:
    """Write whole rows in curve order, as about so many files, for pruning by file statistics."""
    packed, names = _packed(docs, dimensions)
    rows = with_curve(packed, names).repartitionByRange(shards, "curve").sortWithinPartitions("curve")
    rows.select("_row.*").write.parquet(path)
