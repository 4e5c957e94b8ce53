"""Best-fit decreasing packing of token sequences.

Documents are tokenised where they are read; only lengths and checksums go on. Pieces are dealt by
hash to groups of about 16 million tokens, so a group's waste, at most about one open sequence, is
far below a thousandth. Within a group the longest pieces come first, and each goes into the
tightest open sequence that still has room, found by a segment tree over remaining capacities.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import id_text, stored, whole_groups
from chatlake.llm.tokens import ByteTokens

LENGTH = 2048
SEPARATOR = 0
#: Tokens and pieces in a group at most, on average.
GROUP_TOKENS, GROUP_PIECES = 1 << 24, 1 << 18


def cuts(total: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first takes what does not fill a sequence."""
    first = total % length or min(total, length)
    starts = [0, *range(first, total, length)]
    return list(zip(starts, [first, *[length] * (len(starts) - 1)]))


def pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH, separator: int = SEPARATOR) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32` of the tokens of each text and a separator."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens(vocabulary)
        for batch in source:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.append(tokens.ids(text.as_py() or ""), separator).astype("<u4")
                for piece, (start, size) in enumerate(cuts(len(ids), length)):
                    rows.append((doc_id, piece, start, size, zlib.crc32(ids[start : start + size].tobytes())))
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return id_text(docs).mapInArrow(batches, schema)


class OpenBins:
    """Open sequences by remaining capacity, under a segment tree of how many there are."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, room: int, bin_id: int) -> None:
        self.bins[room].append(bin_id)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return (room, bin) of the least room that is at least `size`."""
        count, node = self.count, size + self.leaves
        while not count[node]:
            while node & 1:  # a right child: what follows lies beside an ancestor
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not count[node]:
                node += 1
        room = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.bins[room].pop()


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; the items come longest first."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree, made = OpenBins(capacity), 0
    for at, size in enumerate(lengths.tolist()):
        found = tree.take(size)
        if found is None:
            found = capacity, made
            made += 1
        room, own = found
        bins[at], offsets[at] = own, capacity - room
        if room > size:
            tree.add(room - size, own)
    return bins, offsets


def pack(items: DataFrame, capacity: int = LENGTH) -> DataFrame:
    """`items(doc_id, piece, length, ...)` with `sequence_id` and `offset`.

    Lengths are 1 to capacity. Equal lengths are ordered by doc_id and piece. Items are
    stored once, because their number and sum decide how many groups there are. Repeated
    items are items of their own, and are dealt to groups by their place in the stored table; no items give no rows.
    """
    names = items.columns
    items = stored(items.withColumn("_row", F.monotonically_increasing_id()))
    size = items.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    groups = max(1, ceil(size[0] / GROUP_TOKENS), ceil(size[1] / GROUP_PIECES))
    dealt = items.withColumn("g", F.pmod(F.xxhash64(*names, "_row"), F.lit(groups)).cast("long")).drop("_row")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(source, "g"):
            groups = table.column("g").to_numpy()
            edges = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1], True])
            for low, high in zip(edges, edges[1:]):
                part = table.slice(low, high - low).sort_by(
                    [("length", "descending"), *[(c, "ascending") for c in names if c != "length"]]
                )
                bins, offsets = best_fit(part.column("length").to_numpy(), capacity)
                out = part.drop_columns(["g"]).append_column("sequence_id", pa.array(bins + (int(groups[low]) << 32)))
                yield from out.append_column("offset", pa.array(offsets)).to_batches(max_chunksize=1 << 16)

    fields = [f"`{n}` {k}" for n, k in items.dtypes if n != "_row"]
    schema = ", ".join([*fields, "sequence_id long", "offset long"])
    return dealt.repartition("g").sortWithinPartitions("g").mapInArrow(batches, schema)


def packed_documents(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """Every piece of every document with its sequence and place.

    Null texts are empty; an empty text is its separator alone. Rows with equal ids are documents of their
    own, and a null doc_id stays null. No rows give no rows.
    """
    return pack(pieces(docs, vocabulary, length), length)
