"""Mix sources to target weights by weighted sampling without replacement, in native expressions.

Every document gets an Efraimidis-Spirakis key, -ln(u) / weight with u from a hash of its id and text;
small keys come first. A source's target is reached by complete epochs and then by the
documents with the smallest keys, until the words that are left of the budget are used up. The
place where the budget ends is found by histograms, each of the step in which the last one ended, so no source is
sorted. Keys are compared by their logarithms, which weights only move, so no weight crowds them. Only rows whose keys agree in
all bits and that lie in one piece of the stored table are summed up one by one; all others are decided by the cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatlake.llm.common import stored, words

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
EPOCHS = 2
SEED = 42
#: Logarithms of keys from -48 to 16, of which no weight between 1e-5 and 1e5 leaves much, in four digits.
_LOWEST, _SPAN = -48, 64
_DIGIT, _LEVELS = 13, 4
_KEY_BITS = _DIGIT * _LEVELS
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row in partition below


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0.1 and 1: how near the mean length of a text's words is to six characters."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(0.1), F.coalesce(1 / (1 + F.abs(mean - 7) / 4), F.lit(0.1)))


def sampling_key(identity: Column, weight: Column, seed: int = SEED) -> Column:
    """The logarithm of -ln(u) / weight in 52 bits, in the order of the keys."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), identity), 12).cast("double") + 0.5) / float(1 << 52)
    place = (F.log(-F.log(u) / weight) - _LOWEST) * float((1 << _KEY_BITS) // _SPAN)
    return F.greatest(F.lit(0), F.least(F.floor(place), F.lit((1 << _KEY_BITS) - 1))).cast("long")


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """`sizes(key, source, source_size)`, one row for each source, with `target`.

    Sources in order of code point, null last, get the weights in turn. Targets are weight x
    level, but at most epochs x source_size; with sources in the order of the level at which they
    are full, the level follows from the sizes of full sources and the weights of others.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
    weighed = weighed.withColumn("cap", F.lit(float(epochs)) * F.col("source_size"))
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = filled.rowsBetween(Window.unboundedPreceding, -1)
    rest = filled.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.lit(share) * F.sum("source_size").over(everything)
    level = (budget - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum("weight").over(rest)
    ranked = weighed.withColumn("_level", level).withColumn("_place", F.row_number().over(filled))
    # The first source that is not full at its own level tells the level of all later ones.
    full_at = F.col("cap") / F.col("weight")
    place = F.struct(full_at, F.col("_place"), F.col("_level"))
    final = F.min(F.when(F.col("_level") < full_at, place)).over(everything)["_level"]
    target = F.coalesce(F.least(F.col("cap"), F.col("weight") * final), F.col("cap"))
    return ranked.select("key", "source", "source_size", target.cast("double").alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
    quality=quality_weight,
    keep: Sequence[str] = (),
) -> DataFrame:
    """`doc_id, source, size, source_size, target, taken` for every row of `docs(doc_id, source, text)`.

    Sizes and targets are in words. taken is epochs x size and, in the last epoch, the size again
    or, for the one document of a source at which its budget ends, the words that are left; so the sum
    over a source is its target, rounded to whole words. `quality(text, size)` gives the weights, above 0. `keep`
    names columns to carry along, other than those of the result (ValueError). Null texts have size 0 and null sources are a
    source of their own. Rows with equal ids and different texts have keys of their own; rows equal in both have equal
    keys, and the budget may end within them. A run is repeated with equal results. No rows give no rows.
    """
    result = ["doc_id", "source", "size", "source_size", "target", "taken"]
    if clashing := sorted(set(result) & set(keep)):
        raise ValueError(f"columns of the result cannot be kept: {clashing}")
    text, size = F.col("text"), F.col("size")
    identity = F.struct(F.col("doc_id"), text)
    # Kept columns travel as one struct, so that no name of theirs meets one of the steps below.
    kept = [F.struct(*keep).alias("_kept")] if keep else []
    narrow = stored(
        docs.select(
            F.col("doc_id").cast("long"), F.col("source").cast("string"), words(text).alias("size"), text, *kept
        ).select(
            "doc_id",
            "source",
            "size",
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"),
            sampling_key(identity, quality(text, size), seed).alias("v"),
            F.monotonically_increasing_id().alias("row"),
            *(["_kept"] if keep else []),
        )
    )
    by_source = narrow.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
    left = F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    budgets = stored(targets(by_source, weights, share, epochs).withColumn("whole", whole).withColumn("left", left))
    cut = _cut(narrow, budgets.filter("left > 0").select("key", "left"))
    rows = narrow.join(budgets.select("key", "source_size", "target", "whole"), "key").join(cut, "key", "left")
    at_cut = F.coalesce((F.col("v") == F.col("cut_v")) & (_piece() == F.col("cut_piece")), F.lit(False))
    is_before = (F.col("v") < F.col("cut_v")) | ((F.col("v") == F.col("cut_v")) & (_piece() < F.col("cut_piece")))
    others = rows.filter(~at_cut).withColumn("part", F.when(is_before, size).otherwise(0))
    earlier = Window.partitionBy("key").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    remaining = F.greatest(F.lit(0), F.least(size, F.col("last") - before))
    both = others.unionByName(rows.filter(at_cut).withColumn("part", remaining))
    taken = (F.col("whole") * size + F.col("part")).cast("long").alias("taken")
    return both.select(*result[:-1], taken, *(["_kept.*"] if keep else []))


def _piece() -> Column:
    """The piece of the stored table that a row lies in."""
    return F.shiftright("row", _ROW_BITS)


def _cut(narrow: DataFrame, budgets: DataFrame) -> DataFrame:
    """`(key, cut_v, cut_piece, last)`: where the budget `left` of a source ends.

    Rows before (cut_v, cut_piece) fit in; `last` words are left for those at it.
    """

    def ended(inside: DataFrame, step: Column) -> DataFrame:
        sums = inside.groupBy("key", "left", "prefix", step.alias("step")).agg(F.sum("size").alias("n"))
        earlier = Window.partitionBy("key").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        return sums.filter("before < left and before + n >= left").select(
            "key", (F.col("left") - F.col("before")).alias("left"), "prefix", "step"
        )

    sized = narrow.filter("size > 0").select("key", "v", "row", "size")
    bound = stored(budgets.select("key", "left", F.lit(0).cast("long").alias("prefix")))
    for level in range(1, _LEVELS + 1):
        shift = _KEY_BITS - _DIGIT * level
        inside = sized.join(bound, "key").filter(F.shiftright("v", shift + _DIGIT) == F.col("prefix"))
        bound = stored(ended(inside, F.shiftright("v", shift)).select("key", "left", F.col("step").alias("prefix")))
    found = ended(sized.join(bound, "key").filter("v = prefix"), _piece())
    return stored(
        found.select("key", F.col("prefix").alias("cut_v"), F.col("step").alias("cut_piece"), F.col("left").alias("last"))
    )
