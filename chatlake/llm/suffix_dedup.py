"""Exact removal of repeated byte strings, by a distributed merge sort of sparse suffixes.

A string of LENGTH bytes that starts at p is found by its anchor: of the grams in it, the one with
the least hash, the rightmost of equal ones. Equal strings have equal anchors at equal offsets, so it
is enough to sort the suffixes that start at anchors, one byte in forty. Texts are dealt into
blocks by doc_id and a digest of the text, so that no id is hot, and one shuffle of them serves all three readings:

1. Each block sends the distinct hashes of its anchors to the tasks that own them, and learns which
   occur more than once in the corpus.
2. For those anchors it sorts the suffixes, with the bytes in front as payload, and sends them as front-coded runs: of
   every suffix only what differs from the one before. Anchors whose surroundings equal earlier ones of the
   block throughout are settled there and then, so a passage that is in a third of all documents is
   sent once for each block. Anchors above HOT occurrences are sent as one suffix for each string they
   stand for, dealt by a hash of the whole string, so that different edges of a common passage spread.
3. A task merges its runs with a loser tree that carries common prefix lengths: of two heads the one
   with the longer prefix in common with the last winner is smaller, and equal lengths are compared
   from there on only. Suffixes with a gram in common come out together, and of the strings they
   stand for, all but the earliest are repeats.
4. Repeats go back to their block, where their union is cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chatlake.llm.common import mixed, partitions
from chatlake.llm.winnowing import PORTION, gram_hashes, least_in_windows

LENGTH, GRAM = 100, 20
HOT = 2048
#: Bytes of text in a block, on average.
BLOCK_BYTES = 1 << 22
#: Suffixes whose strings are compared at once.
CHUNK = 1 << 14
RESULTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")

_FIRST_ID = -(1 << 63)


def text_order(text: bytes) -> int:
    """Place of a text among those of its doc_id: 32 bits of what Spark's xxhash64 gives."""
    return xxhash.xxh64_intdigest(text, seed=42) & 0xFFFFFFFF


class Block(NamedTuple):
    """Texts of a block in order of (doc_id, order, text), equal rows being one document."""

    data: bytes
    ids: list[int]
    orders: list[int]
    starts: np.ndarray
    row_doc: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Block:
        ids = [_FIRST_ID if i is None else i for i in table.column("doc_id").to_pylist()]
        texts = [(t or "").encode("utf-8", "surrogatepass") for t in table.column("text").to_pylist()]
        orders = [text_order(t) for t in texts]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], orders[i], texts[i]))
        row_doc, docs = np.empty(len(ids), np.int64), []
        for i in order:
            if not docs or (ids[docs[-1]], texts[docs[-1]]) != (ids[i], texts[i]):
                docs.append(i)
            row_doc[i] = len(docs) - 1
        parts = [texts[i] for i in docs]
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return cls(b"".join(parts), [ids[i] for i in docs], [orders[i] for i in docs], starts, row_doc)


class Anchors(NamedTuple):
    """Anchors of a block by position, with the first and last string each stands for."""

    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, block: Block, length: int, gram: int) -> Anchors:
        points = np.frombuffer(block.data, np.uint8)
        count, window = len(points) - length + 1, length - gram + 1
        chosen, values = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for start in range(0, max(count, 0), PORTION):
            part = points[start : start + PORTION + length - 1]
            hashes = gram_hashes(part, gram)
            best = least_in_windows(hashes, window)[: PORTION]
            chosen.append(best + start)
            values.append(hashes[best])
        best, values = np.concatenate(chosen), np.concatenate(values)
        sizes = np.diff(block.starts)
        ends = np.repeat(block.starts[1:], sizes)[: len(best)]
        valid = np.flatnonzero(np.arange(len(best)) + length <= ends)
        own = best[valid]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]] if len(own) else np.zeros(0, bool))
        last = np.r_[first[1:], len(own)] - 1 if len(first) else first
        at = own[first]
        doc = np.searchsorted(block.starts, at, side="right") - 1
        return cls(at, valid[first], valid[last], doc, values[valid[first]])

    def lists(self, parts: int):
        """(distinct hashes in the order of (owner, hash), owners, place of each anchor's hash)."""
        distinct, place = np.unique(self.hashes, return_inverse=True)
        owner = (distinct % np.uint64(parts)).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return distinct[order], owner[order], rank[place.ravel()]


def _runs_of(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, low, high) of runs of equal values."""
    edges = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else []
    for low, high in zip(edges, edges[1:]):
        yield int(values[low]), int(low), int(high)


# --- 1. which grams repeat -------------------------------------------------------------------


_LIST = "block long, part int, data binary"


def _send_hashes(length: int, gram: int, parts: int):
    def send(table: pa.Table) -> pa.Table:
        number = table.column("_block")[0].as_py()
        anchors = Anchors.of(Block.of(table), length, gram)
        distinct, owner, place = anchors.lists(parts)
        seen = np.minimum(np.bincount(place, minlength=len(distinct)), 65535).astype("<u2")
        # Six bytes of a hash: a chance agreement only adds a suffix to be sorted.
        short = (distinct // np.uint64(parts)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        out = [
            (number, part, short[low:high].tobytes() + zstandard.compress(seen[low:high].tobytes()), high - low)
            for part, low, high in _runs_of(owner)
        ]
        blocks, owners, data, sizes = map(list, zip(*out)) if out else ([], [], [], [])
        return pa.table(
            [pa.array(blocks, pa.int64()), pa.array(owners, pa.int32()), pa.array(data, pa.binary()), pa.array(sizes, pa.int32())],
            names=["block", "part", "data", "n"],
        )

    return send


def _answer_hashes(hot: int):
    def answer(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, hashes, counts = [], [], []
        for batch in source:
            for block, part, data, n in zip(*(batch.column(c).to_pylist() for c in ("block", "part", "data", "n"))):
                heads.append((block, part, n))
                short = np.zeros((n, 8), np.uint8)
                short[:, :6] = np.frombuffer(data, np.uint8, 6 * n).reshape(n, 6)
                hashes.append(short.view("<u8").ravel())
                counts.append(np.frombuffer(zstandard.decompress(data[6 * n :]), "<u2"))
        if not heads:
            return
        _, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(counts))[place]
        flags = ((total > 1).astype(np.uint8) + (total > hot)).astype(np.uint8)
        ends = np.cumsum([n for _, _, n in heads])
        data = [zstandard.compress(flags[end - n : end].tobytes()) for (_, _, n), end in zip(heads, ends)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([h[0] for h in heads], pa.int64()), pa.array([h[1] for h in heads], pa.int32()), pa.array(data, pa.binary())],
            ["block", "part", "data"],
        )

    return answer


# --- 2. sorted runs ---------------------------------------------------------------------------


class Entry(NamedTuple):
    suffix: bytes
    left: bytes
    ahead: int  # from the last string's start to the anchor
    doc: int
    doc_id: int
    at: int  # in the document
    order: int = 0  # of the text among those of its doc_id


def _common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of a and b, which agree before `start`."""
    end = min(len(a), len(b))
    if a[start:end] == b[start:end]:
        return end
    while a[start : start + 8] == b[start : start + 8]:
        start += 8
    while a[start] == b[start]:
        start += 1
    return start


def encode_run(entries: list[Entry]) -> bytes:
    """Front-coded: suffixes sorted, each without what it has in common with the one before."""
    entries = sorted(entries, key=lambda e: e.suffix)
    shared, rest, before = [], [], b""
    for entry in entries:
        common = _common(before, entry.suffix, 0)
        shared.append(common)
        rest.append(entry.suffix[common:])
        before = entry.suffix
    columns = [
        np.array(shared, "<u2"),
        np.array([len(r) for r in rest], "<u2"),
        np.array([len(e.left) for e in entries], "<u2"),
        np.array([e.ahead for e in entries], "<u2"),
        np.array([e.doc for e in entries], "<u4"),
        np.array([e.doc_id for e in entries], "<i8"),
        np.array([e.at for e in entries], "<u8"),
        np.array([e.order for e in entries], "<u4"),
    ]
    body = b"".join([len(entries).to_bytes(4, "little"), *(c.tobytes() for c in columns), *rest, *(e.left for e in entries)])
    return zstandard.compress(body, 3)


class Run:
    """A decoded run; suffixes are put together one after the other."""

    def __init__(self, data: bytes, block: int):
        body = zstandard.decompress(data)
        n, at = int.from_bytes(body[:4], "little"), 4
        columns = []
        for kind in ("<u2", "<u2", "<u2", "<u2", "<u4", "<i8", "<u8", "<u4"):
            columns.append(np.frombuffer(body, kind, n, at))
            at += columns[-1].nbytes
        self.block, self.size, self.body = block, n, body
        self.shared, sizes, lefts = (c.tolist() for c in columns[:3])
        self.ahead, self.doc, self.doc_id, self.place, self.order = columns[3:]
        self.rest_at = (at + np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])).astype(np.int64).tolist()
        self.left_at = (self.rest_at[-1] + np.concatenate([[0], np.cumsum(lefts, dtype=np.int64)])).astype(np.int64).tolist()
        self.next, self.suffix = 0, b""

    def advance(self) -> int:
        """Go to the next suffix; how much it shares with the one before, -1 at the end."""
        i = self.next
        if i == self.size:
            return -1
        self.next = i + 1
        common = self.shared[i]
        self.suffix = self.suffix[:common] + self.body[self.rest_at[i] : self.rest_at[i + 1]]
        return common

    def left(self, i: int) -> bytes:
        return self.body[self.left_at[i] : self.left_at[i + 1]]


_SENT = "part int, block long, is_run boolean, data binary"


def _send_runs(length: int, gram: int, parts: int):
    def send(table: pa.Table, flags: pa.Table) -> pa.Table:
        runs: dict[int, list[Entry]] = {}
        marks: list[tuple[int, int, int]] = []
        number = -1
        if table.num_rows:
            number = table.column("_block")[0].as_py()
            block = Block.of(table)
            anchors = Anchors.of(block, length, gram)
            distinct, owner, place = anchors.lists(parts)
            answers = dict(zip(flags.column("part").to_pylist(), flags.column("data").to_pylist()))
            lists = [np.frombuffer(zstandard.decompress(answers[p]), np.uint8) for p, _, _ in _runs_of(owner)]
            flag = np.concatenate(lists)[place] if lists else np.zeros(0, np.uint8)
            chosen = np.flatnonzero(flag)
            starts, data, ids, orders = block.starts.tolist(), block.data, block.ids, block.orders
            seen: set = set()
            columns = (anchors.at, anchors.low, anchors.high, anchors.doc, owner[place], flag)
            for at, low, high, doc, part, how in zip(*(c[chosen].tolist() for c in columns)):
                text = data[low : high + length]
                key = (at - low, text)
                start = starts[doc]
                if key in seen:
                    marks.append((doc, low - start, high + length - start))
                    continue
                seen.add(key)
                if how == 1:
                    entry = Entry(text[at - low :], text[: at - low], at - high, doc, ids[doc], at - start, orders[doc])
                    runs.setdefault(part, []).append(entry)
                    continue
                for p in range(low, high + 1):
                    string = data[p : p + length]
                    if string in seen:
                        marks.append((doc, p - start, p + length - start))
                        continue
                    seen.add(string)
                    to = xxhash.xxh64_intdigest(string) % parts
                    runs.setdefault(to, []).append(Entry(string, b"", 0, doc, ids[doc], p - start, orders[doc]))
        out = [(part, number, True, encode_run(entries)) for part, entries in runs.items()]
        if marks:
            out.append((number % parts, number, False, encode_marks(np.array(marks))))
        columns = list(zip(*out)) if out else [(), (), (), ()]
        kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "block", "is_run", "data"])

    return send


def encode_marks(marks: np.ndarray) -> bytes:
    """Rows (document of the block, start, end)."""
    return zstandard.compress(np.ascontiguousarray(marks.astype("<u8").T).tobytes(), 3)


def decode_marks(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<u8").astype(np.int64).reshape(3, -1).T


# --- 3. merge ---------------------------------------------------------------------------------


def merged(runs: list[Run]) -> Iterator[tuple[int, Run, int]]:
    """(prefix in common with the one before, run, place in it) of all suffixes in order."""
    k = len(runs)
    shared = [run.advance() for run in runs]
    tree = [-1] * k  # the loser of each match; leaves are k to 2k - 1

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's prefix is then that with the winner."""
        x, y = shared[a], shared[b]
        if x > y:
            return a, b
        if y > x:
            return b, a
        if x < 0:
            return a, b
        left, right = runs[a].suffix, runs[b].suffix
        common = _common(left, right, x)
        if left[common:] <= right[common:]:
            shared[b] = common
            return a, b
        shared[a] = common
        return b, a

    winners = [-1] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        winners[node], tree[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if k > 1 else 0
    while k and shared[best] >= 0:
        run = runs[best]
        yield shared[best], run, run.next - 1
        shared[best] = run.advance()
        node = (best + k) >> 1
        while node:
            best, tree[node] = play(best, tree[node])
            node >>= 1


def repeats(groups: np.ndarray, entries: list[tuple[Run, int, bytes]], length: int, gram: int):
    """(entry, first start, last start) in the document: runs of strings that an earlier entry of the group has.

    Strings of a group are equal if their anchors' offsets and their bytes are. Polynomial
    hashes bring equal ones together, and then their bytes are compared.
    """
    wide = length - gram
    rows = [run.left(i).rjust(wide, b"\0") + suffix.ljust(length, b"\0") for run, i, suffix in entries]
    bytes_of = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), wide + length)
    sums = np.zeros((len(rows), wide + length + 1), np.uint64)
    np.cumsum((bytes_of + np.uint64(1)) * _weights(wide + length), axis=1, out=sums[:, 1:])
    ahead = np.array([int(run.ahead[i]) for run, i, _ in entries])
    back = np.array([run.left_at[i + 1] - run.left_at[i] for run, i, _ in entries])
    place = np.array([int(run.place[i]) for run, i, _ in entries])
    ids = np.array([int(run.doc_id[i]) for run, i, _ in entries])
    docs = np.array([int(run.doc[i]) for run, i, _ in entries])
    orders = np.array([int(run.order[i]) for run, i, _ in entries])
    # Texts that agree in (id, order) are in one block, which numbers them.
    order = np.lexsort((place, docs, orders, ids))
    counts = (back - ahead + 1)[order]
    entry = np.repeat(order, counts)
    offset = np.arange(len(entry)) - np.repeat(np.cumsum(counts) - counts, counts) + ahead[entry]
    value = sums[entry, wide - offset + length] - sums[entry, wide - offset]
    key = mixed(value ^ mixed((groups[entry] * (wide + 1) + offset).astype(np.uint64)))
    by_key = np.argsort(key, kind="stable")
    later = np.zeros(len(entry), bool)
    pairs = np.flatnonzero(key[by_key[1:]] == key[by_key[:-1]])
    later[by_key[pairs + 1]] = True
    strings = np.lib.stride_tricks.sliding_window_view(bytes_of, length, axis=1)
    for low in range(0, len(pairs), 1 << 15):
        a, b = by_key[pairs[low : low + (1 << 15)]], by_key[pairs[low : low + (1 << 15)] + 1]
        differ = (groups[entry[a]] != groups[entry[b]]) | (offset[a] != offset[b])
        differ |= (strings[entry[a], wide - offset[a]] != strings[entry[b], wide - offset[b]]).any(axis=1)
        for value in np.unique(key[a[differ]]):  # a chance agreement
            seen: set = set()
            for i in by_key[key[by_key] == value]:
                string = groups[entry[i]], offset[i], strings[entry[i], wide - offset[i]].tobytes()
                later[i] = string in seen
                seen.add(string)
    hit = np.flatnonzero(later)
    starts = place[entry[hit]] - offset[hit]
    # Offsets of an entry go up, so starts go down; a break begins another run.
    new = np.r_[True, (entry[hit][1:] != entry[hit][:-1]) | (starts[1:] != starts[:-1] - 1)] if len(hit) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(hit)] - 1 if len(first) else first
    return entry[hit][first], starts[last], starts[first]


def _weights(count: int) -> np.ndarray:
    base = np.full(count, np.uint64(0x9E3779B97F4A7C15), np.uint64)
    return np.multiply.accumulate(base)


def _merge(length: int, gram: int, chunk: int):
    def merge(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[Run] = []
        found: dict[int, list[np.ndarray]] = {}
        for batch in source:
            for block, is_run, data in zip(*(batch.column(c).to_pylist() for c in ("block", "is_run", "data"))):
                if is_run:
                    runs.append(Run(data, block))
                else:
                    found.setdefault(block, []).append(decode_marks(data))

        def settle(groups: list[int], entries: list) -> None:
            ids, lows, highs = repeats(np.array(groups), entries, length, gram)
            for i, low, high in zip(ids.tolist(), lows.tolist(), highs.tolist()):
                run, at, _ = entries[i]
                found.setdefault(run.block, []).append(np.array([[int(run.doc[at]), low, high + length]]))

        groups, entries, group, begun = [], [], 0, 0
        for shared, run, at in merged(runs):
            if shared < gram:
                if len(entries) - begun == 1:  # alone with its gram
                    entries.pop()
                    groups.pop()
                if len(entries) >= chunk:
                    settle(groups, entries)
                    groups, entries = [], []
                begun, group = len(entries), group + 1
            groups.append(group)
            entries.append((run, at, run.suffix))
        if entries:
            settle(groups, entries)
        blocks = list(found)
        for low in range(0, len(blocks), 256):
            part = blocks[low : low + 256]
            data = [encode_marks(np.concatenate(found[b])) for b in part]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(data, pa.binary())], ["block", "data"])

    return merge


# --- 4. cut out -------------------------------------------------------------------------------


def spans(marks: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of rows (start, end); rows that touch are one run."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(map(tuple, marks.tolist())):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def _cut(names: list[str]):
    def cut(table: pa.Table, marks: pa.Table) -> pa.Table:
        block = Block.of(table) if table.num_rows else None
        rows = [decode_marks(x) for x in marks.column("data").to_pylist()]
        own = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
        own = own[np.argsort(own[:, 0], kind="stable")]
        of_doc = {doc: own[low:high, 1:] for doc, low, high in _runs_of(own[:, 0])}
        results = {}
        for doc in range(len(block.ids) if block else 0):
            text = block.data[block.starts[doc] : block.starts[doc + 1]]
            gone = spans(of_doc[doc]) if doc in of_doc else []
            edges = [0, *(e for span in gone for e in span), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            results[doc] = (len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore"))
        found = [results[d] for d in block.row_doc.tolist()] if block else []
        columns = list(zip(*found)) if found else [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        out = table.select(names)
        for name, values, kind in zip(RESULTS, columns, kinds):
            out = out.append_column(name, pa.array(values, kind))
        return out

    return cut


def deduplicated(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, block_bytes: int = BLOCK_BYTES, chunk: int = CHUNK
) -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans, kept_sha256 and kept_text for every row.

    Removed is each byte covered by a string of `length` bytes that also starts earlier: in a row with a smaller doc_id, or
    earlier in the same text. Texts are UTF-8; kept_sha256 is of the bytes that are left, and
    kept_text leaves out what is left of characters that were cut. Null texts are empty. A null doc_id is
    smaller than any other. Rows with equal doc_id and text are one document, with one
    result for all of them; rows with equal doc_id only are in order of 32 bits of their text's hash, then of the text. No rows give no rows. Other columns are carried along, except
    those named like a result, which are replaced, and one named _block, which is left out.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in RESULTS and c != "_block"]
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    parts = partitions(spark)
    blocks = max(parts, ceil(size / block_bytes))
    docs = docs.select(*names).withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    order = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF))
    key = F.xxhash64(F.coalesce("doc_id", F.lit(_FIRST_ID)), order)
    dealt = docs.withColumn("_block", F.pmod(key, F.lit(blocks)))
    by_block = dealt.groupBy("_block")

    lists = by_block.applyInArrow(_send_hashes(length, gram, parts), f"{_LIST}, n int")
    flags = lists.repartitionById(parts, F.col("part")).mapInArrow(_answer_hashes(hot), _LIST)
    flags = flags.withColumnRenamed("block", "_block")
    sent = by_block.cogroup(flags.groupBy("_block")).applyInArrow(_send_runs(length, gram, parts), _SENT)
    marks = sent.repartitionById(parts, F.col("part")).mapInArrow(_merge(length, gram, chunk), "block long, data binary")
    marks = marks.withColumnRenamed("block", "_block")
    kinds = [LongType(), LongType(), LongType(), StringType(), StringType()]
    schema = StructType([*docs.schema.fields, *(StructField(n, k) for n, k in zip(RESULTS, kinds))])
    return by_block.cogroup(marks.groupBy("_block")).applyInArrow(_cut(names), schema)
