"""SimHash near-duplicates, compared by bit planes.

1. A fingerprint for each text, in Arrow batches, of one or more words of 64 bits.
2. Equal fingerprints are one node. Nodes are put into buckets by some of their bits:
   - within a small radius r, exactly: two fingerprints agree on at least m - r of m chunks of their
     bits, so there is one bucket for every choice of m - r chunks, and no pair is missed whatever m is;
   - for a similarity, where r is a fifth of the bits: as many random choices of bits as meet with the
     given probability for pairs at the radius.
   The number of bits follows from the number of nodes, so that buckets of unrelated texts stay small.
3. Large buckets are cut into blocks by hash, and each pair of blocks is a group of its own.
4. In a group, 64 fingerprints are one column of words, one word for each bit. A fingerprint is
   compared with 64 others by one XOR for each plane, whose bits are summed by carry-save adders in
   counter words; words in which all counters exceed the radius are abandoned every eight planes.
5. Links of a group leave it as a spanning forest, and components are found over all groups.

For a similarity, fingerprints are of sets of shingles and only propose pairs; a pair links if the Jaccard
similarity of the two sets, of 64-bit hashes, is high enough. A few choices of bits give forests that join most
near copies first; then every pair met that is not yet in one component is tried. Sets so small that few
shingles decide a bit meet by their smallest shingles instead: two similar ones share one of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import acos, ceil, comb, log, log2, pi
from random import Random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import discard, id_text, mixed, stored, whole_groups
from chatlake.llm.components import connected_components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints in a block; a group compares two blocks.
BLOCK = 2048
#: Unrelated fingerprints to expect in a bucket at most, when the number of chunks is chosen.
CROWD = 4096
#: Probability that a pair at the radius of a similarity meets in a bucket.
RECALL = 0.99
#: Standard deviations that the radius of a similarity lies above the bits to expect there.
SLACK = 3.0
#: Shingles up to which a set also meets others by its smallest shingles, and the deviations allowed there.
SMALL, SMALL_SLACK = 32, 6.0
#: Choices of bits that are used for the first forests.
FIRST = 8

_ONE = np.uint64(1)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE, width: int = 1) -> list[int]:
    """SimHash of the word shingles, repeats included, as words of 64 bits; 0 without shingles.

    The first word is of the shingles' XXH64, the others of hashes made from it.
    """
    return _print(_shingles(text, shingle), width)


def _shingles(text: str | None, shingle: int) -> np.ndarray:
    terms = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not terms:
        return np.zeros(0, np.uint64)
    line = b" ".join(terms)
    ends = (np.cumsum(np.fromiter(map(len, terms), np.int64, len(terms)) + 1) - 1).tolist()
    starts = [0, *(end + 1 for end in ends[:-1])]
    last = ends[shingle - 1 :] or ends[-1:]
    return np.fromiter(
        (xxhash.xxh64_intdigest(line[i:j], SEED) for i, j in zip(starts, last)), np.uint64, len(last)
    )


def _print(hashes: np.ndarray, width: int) -> list[int]:
    if not len(hashes):
        return [0] * width
    return [_majority(hashes if i == 0 else mixed(hashes + np.uint64(i))) for i in range(width)]


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # Eight counters of a byte are added as one word; 255 rows cannot overflow them.
        sums = np.add.reduceat(bits.view(np.uint64), np.arange(0, len(part), 255), axis=0)
        ones += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(sum(1 << bit for bit in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, width: int = 1) -> DataFrame:
    """`(doc_id, fp)` of every row, fp being its words; null and empty texts have fingerprint 0."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            values = [fingerprint(x.as_py(), shingle, width) for x in batch.column("text")]
            flat = pa.array(np.array(values, np.uint64).reshape(-1).view(np.int64))
            fp = pa.ListArray.from_arrays(np.arange(0, width * len(values) + 1, width, dtype=np.int32), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fp], ["doc_id", "fp"])

    return id_text(docs).mapInArrow(batches, "doc_id long, fp array<long>")


def shingle_sets(docs: DataFrame, shingle: int, width: int) -> DataFrame:
    """`(doc_id, digest, n, fp, terms)` of every row: the set of its shingles' hashes in order, their
    number, a digest and a fingerprint of the set."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            sets = [np.unique(_shingles(x.as_py(), shingle)) for x in batch.column("text")]
            digests = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
            prints = np.array([_print(x, width) for x in sets], np.uint64).reshape(-1).view(np.int64)
            ends = np.cumsum([0, *map(len, sets)])
            terms = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            columns = [
                batch.column("doc_id"),
                pa.array(digests, pa.binary()),
                pa.array(np.diff(ends).astype(np.int32)),
                pa.ListArray.from_arrays(np.arange(0, width * len(sets) + 1, width, dtype=np.int32), pa.array(prints)),
                pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(terms)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "n", "fp", "terms"])

    return id_text(docs).mapInArrow(batches, "doc_id long, digest binary, n int, fp array<long>, terms array<long>")


def within(planes: np.ndarray, query: np.ndarray, word: np.ndarray, masks: np.ndarray, radius: int):
    """For each (query, word): the bits of those of the word's 64 fingerprints within the radius.

    planes[b] holds bit b of all fingerprints, 64 to a word; masks has all ones or zero for
    bit b of each query. Returns the surviving (query, word, bits).
    """
    digits = max(1, radius.bit_length())
    counters = [np.zeros(len(query), np.uint64) for _ in range(digits)]
    over = np.zeros(len(query), np.uint64)
    beyond = over
    for at in range(0, len(planes), 8):
        for bit in range(at, at + 8, 2):
            x = planes[bit][word] ^ masks[bit][query]
            y = planes[bit + 1][word] ^ masks[bit + 1][query]
            half = counters[0] ^ x
            carry = (counters[0] & x) | (half & y)
            counters[0] = half ^ y
            for digit in range(1, digits):
                carry, counters[digit] = counters[digit] & carry, counters[digit] ^ carry
            over |= carry
        if at + 8 <= radius:
            continue
        beyond = over | _above(counters, radius)
        alive = np.flatnonzero(beyond != _FULL)
        if len(alive) < len(query):
            query, word, over, beyond, *counters = (v[alive] for v in (query, word, over, beyond, *counters))
        if not len(query):
            break
    return query, word, ~beyond


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Counters, as binary numbers with the lowest digit first, above the radius."""
    more, same = np.zeros_like(counters[0]), np.full_like(counters[0], _FULL)
    for digit in range(len(counters) - 1, -1, -1):
        if radius >> digit & 1:
            same = same & counters[digit]
        else:
            more |= same & counters[digit]
            same = same & ~counters[digit]
    return more


def links(groups: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs within the radius, rows of a group standing together.

    fps has a row of 64-bit words for each fingerprint.
    """
    label = np.arange(len(fps))
    for left, right in close_pairs(groups, fps, radius):
        _join(label, left, right)
    child = np.flatnonzero(label != np.arange(len(label)))
    return child, label[child]


def close_pairs(groups: np.ndarray, fps: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows of a group within the radius, the smaller row first."""
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[starts, len(groups)])
    n_words = (sizes + 63) // 64
    first_word = np.cumsum(n_words) - n_words
    # Place of each row in the padded columns, where each group starts a word.
    place = np.arange(len(groups)) - np.repeat(starts, sizes) + np.repeat(first_word * 64, sizes)
    n_padded, width = int(n_words.sum()) * 64, fps.shape[1]
    row_at = np.full(n_padded, -1, np.int64)
    row_at[place] = np.arange(len(fps))
    shifts = np.arange(64, dtype=np.uint64)

    def gathered(bits: np.ndarray) -> np.ndarray:
        return (bits.astype(np.uint64).reshape(-1, 64) << shifts).sum(axis=1, dtype=np.uint64)

    planes, masks = np.empty((64 * width, n_padded // 64), np.uint64), np.empty((64 * width, len(fps)), np.uint64)
    padded = np.zeros((n_padded, width), np.uint64)
    padded[place] = fps
    for bit in range(64 * width):
        at, shift = bit // 64, np.uint64(bit % 64)
        planes[bit] = gathered((padded[:, at] >> shift) & _ONE)
        masks[bit] = np.uint64(0) - ((fps[:, at] >> shift) & _ONE)
    real = gathered(row_at >= 0)
    per_row = np.repeat(n_words, sizes)
    query = np.repeat(np.arange(len(fps)), per_row)
    word = np.arange(len(query)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    word += np.repeat(np.repeat(first_word, sizes), per_row)
    for low in range(0, len(query), 1 << 16):
        some, column, bits = within(planes, query[low : low + (1 << 16)], word[low : low + (1 << 16)], masks, radius)
        bits = bits & real[column]
        for at in range(0, len(some), 1 << 14):
            part = bits[at : at + (1 << 14)]
            flat = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            i, bit = np.nonzero(flat)
            left = some[at : at + (1 << 14)][i]
            right = row_at[column[at : at + (1 << 14)][i] * 64 + bit]
            apart = left < right
            yield left[apart], right[apart]


def _join(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Lower the labels until both ends of each pair have the same, the smallest row's."""
    while len(left):
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            higher = label[label]
            if (higher == label).all():
                break
            label[:] = higher


def _chunks(nodes: int, radius: int) -> int:
    """Chunks of the bits: as few as keep buckets of unrelated fingerprints small."""
    chunks = radius + 1
    while nodes / 2 ** (64 * (chunks - radius) // chunks) > CROWD and comb(chunks + 1, radius) < 512:
        chunks += 1
    return chunks


def _masks(chunks: int, radius: int) -> list[list[int]]:
    edges = [64 * i // chunks for i in range(chunks + 1)]
    parts = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    return [[sum(choice)] for choice in combinations(parts, chunks - radius)]


def _random_masks(nodes: int, radius: int, width: int) -> list[list[int]]:
    """Choices of bits, few enough to keep buckets of unrelated texts small, and so many choices
    that a pair at the radius agrees on one of them with probability RECALL."""
    n_bits = max(10, ceil(log2(max(nodes, 1) / CROWD)))
    meet = (1 - radius / (64 * width)) ** n_bits
    random, masks = Random(SEED), []
    for _ in range(ceil(log(1 - RECALL) / log(1 - meet))):
        words = [0] * width
        for bit in random.sample(range(64 * width), n_bits):
            words[bit // 64] |= 1 << bit % 64
        masks.append(words)
    return masks


def similarity_radius(similarity: float, width: int, slack: float = SLACK) -> int:
    """Differing bits to expect at a Jaccard similarity of sets of equal size, and `slack` deviations more."""
    n_bits, share = 64 * width, acos(2 * similarity / (1 + similarity)) / pi
    return round(n_bits * share + slack * (n_bits * share * (1 - share)) ** 0.5)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def linked(nodes: DataFrame, masks: list[list[int]], radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """`(a, b)`: a spanning forest, or a little more, of `nodes(node, fp)` within the radius that meet in a bucket."""
    keys = [F.xxhash64(*[F.col("fp")[i].bitwiseAND(F.lit(_signed(w))) for i, w in enumerate(m) if w]) for m in masks]
    keyed = nodes.select("node", "fp", F.posexplode(F.array(*keys)).alias("choice", "key"))
    crowded = stored(
        nodes.select(F.posexplode(F.array(*keys)).alias("choice", "key"))
        .groupBy("choice", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("choice", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        keyed.join(crowded, ["choice", "key"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node", "fp", F.xxhash64("choice", "key", F.least("own", "other"), F.greatest("own", "other")).alias("g")
        )
    )

    def compare(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(source, "g"):
            groups, node = table.column("g").to_numpy(), table.column("node").to_numpy()
            words = table.column("fp").combine_chunks().flatten().to_numpy().view(np.uint64)
            fps = words.reshape(len(groups), -1)
            for low, high in _portions(groups):
                child, root = links(groups[low:high], fps[low:high], radius)
                part = node[low:high]
                yield pa.RecordBatch.from_arrays([pa.array(part[child]), pa.array(part[root])], ["a", "b"])

    return dealt.repartition("g").sortWithinPartitions("g").mapInArrow(compare, "a long, b long")


def _portions(groups: np.ndarray, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Runs of whole groups, of at least so many rows but for the last."""
    ends = np.flatnonzero(np.r_[groups[1:] != groups[:-1], True]) + 1
    low = 0
    for end in ends.tolist():
        if end - low >= rows or end == len(groups):
            yield low, end
            low = end


def candidates(nodes: DataFrame, keys: Column, radius: int, similarity: float, forest: bool, block: int = BLOCK) -> DataFrame:
    """`(a, b)`, with repeats: pairs of `nodes(node, fp, n, part)` that share one of their `keys`, are of different
    parts, are within the radius and not too different in size; or, as a forest, some pairs that join them."""
    keyed = nodes.select("node", "fp", "n", "part", F.explode(keys).alias("key"))
    crowded = stored(
        nodes.select("part", F.explode(keys).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("part").alias("low"), F.max("part").alias("high"))
        .filter("low < high")
        .select("key", F.ceil(F.col("rows") / block).cast("int").alias("blocks"))
    )
    dealt = (
        keyed.join(crowded, "key")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("node", "fp", "n", "part", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("g"))
    )

    def compare(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(source, "g"):
            groups, node, n, of = (table.column(c).to_numpy() for c in ("g", "node", "n", "part"))
            fps = table.column("fp").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(groups), -1)
            for low, high in _portions(groups):
                here = groups[low:high], fps[low:high], radius
                for left, right in [links(*here)] if forest else close_pairs(*here):
                    left, right = left + low, right + low
                    alike = (of[left] != of[right]) & (
                        np.minimum(n[left], n[right]) >= similarity * np.maximum(n[left], n[right]) - 1e-9
                    )
                    a, b = node[left[alike]], node[right[alike]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"]
                    )

    return dealt.repartition("g").sortWithinPartitions("g").mapInArrow(compare, "a long, b long")


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The distinct `pairs(a, b)` whose `sets(node, terms)` have at least this Jaccard similarity."""
    pairs = stored(pairs.distinct())
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    needed = stored(sets.join(nodes, "node", "left_semi"))
    both = pairs.join(needed.select(F.col("node").alias("a"), F.col("terms").alias("x")), "a").join(
        needed.select(F.col("node").alias("b"), F.col("terms").alias("y")), "b"
    )
    shared = F.size(F.array_intersect("x", "y"))
    found = stored(both.filter(shared / (F.size("x") + F.size("y") - shared) >= similarity).select("a", "b"))
    discard(pairs, needed)
    return found


def similar_sets(docs: DataFrame, shingle: int, similarity: float, width: int, block: int = BLOCK) -> DataFrame:
    """`(doc_id, fp, component_id)` of every row: links are pairs of sets of at least this similarity."""
    prints = stored(shingle_sets(docs, shingle, width).withColumn("row", F.monotonically_increasing_id()))
    nodes = stored(
        prints.groupBy("digest").agg(
            F.min("row").alias("node"), F.min("doc_id").alias("first"), F.first("fp").alias("fp"), F.first("n").alias("n")
        )
    )
    sets = prints.select(F.col("row").alias("node"), "terms")
    bare = nodes.select("node", "fp", "n", F.col("node").alias("part"))
    radius = similarity_radius(similarity, width)
    masks = _random_masks(nodes.count(), radius, width)
    keys = [
        F.xxhash64(F.lit(i), *[F.col("fp")[at].bitwiseAND(F.lit(_signed(w))) for at, w in enumerate(m) if w])
        for i, m in enumerate(masks)
    ]
    near = similarity_radius(similarity, width, 0)
    first = similar(candidates(bare, F.array(*keys[:FIRST]), near, similarity, True, block), sets, similarity)
    parts = connected_components(first)
    joined = stored(
        bare.drop("part").join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
    )
    # Sorted by hash, two sets of this similarity share one of so many of their first hashes.
    leading = (F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1).cast("int")
    small = stored(
        joined.filter((F.col("n") > 0) & (F.col("n") <= int(SMALL / similarity + 1e-9)))
        .join(sets, "node")
        .select("node", "fp", "n", "part", F.slice("terms", F.lit(1), leading).alias("leading"))
    )
    met = candidates(joined, F.array(*keys), radius, similarity, False, block).unionAll(
        candidates(small, F.col("leading"), similarity_radius(similarity, width, SMALL_SLACK), similarity, False, block)
    )
    more = similar(met, sets, similarity)
    found = connected_components(first.unionAll(more))
    rooted = stored(
        nodes.join(found, "node", "left").select("digest", "first", F.coalesce("component", "node").alias("root"))
    )
    least = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    by_set = stored(rooted.join(least, "root").select("digest", "component_id"))
    discard(nodes, first, parts, joined, small, more, found, rooted, least)
    return prints.join(by_set, "digest").select("doc_id", "fp", "component_id")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    similarity: float | None = None,
    width: int = 1,
    block: int = BLOCK,
) -> DataFrame:
    """`(doc_id, fp, component_id)` of every row of `docs(doc_id, text)`; fp is the array of `width` words.

    Links are pairs of fingerprints of one word with at most `radius` differing bits, all of which are found. Where a
    similarity is given, they are pairs of rows whose sets of shingles have at least this Jaccard similarity, and
    fp is of the set: no other pair links, and a pair at the very limit is missed only if its fingerprints differ by
    SLACK deviations more than expected, or meet in no bucket (RECALL, for pairs at the radius).

    component_id is the smallest doc_id that can be reached over links, the row's own included.
    Null and empty texts have fingerprint 0 and link like any other. Repeated rows stay
    repeated. A null doc_id never is a component's id, unless all its ids are null. No rows
    give no rows; other columns are ignored.
    """
    if similarity is not None:
        return similar_sets(docs, shingle, similarity, width, block)
    if width != 1:
        raise ValueError("a radius is for fingerprints of one word")
    prints = stored(fingerprints(docs, shingle, width))
    nodes = stored(
        prints.groupBy("fp")
        .agg(F.min("doc_id").alias("first"))
        .select(F.monotonically_increasing_id().alias("node"), "fp", "first")
    )
    n_nodes = nodes.count()
    masks = _masks(_chunks(n_nodes, radius), radius)
    found = connected_components(linked(nodes.select("node", "fp"), masks, radius, block))
    rooted = stored(
        nodes.join(found, "node", "left").select("fp", "first", F.coalesce("component", "node").alias("root"))
    )
    least = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    by_print = stored(rooted.join(least, "root").select("fp", "component_id"))
    discard(nodes, found, rooted, least)
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")
