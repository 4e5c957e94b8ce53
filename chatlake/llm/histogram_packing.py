"""Packing by non-negative least squares over a histogram of lengths.

Documents are tokenised and packed in the task that reads them, in groups of about four million
tokens; no token is shuffled.

1. Whole windows are cut from the front of long documents. What is left of each is shorter than a window.
2. Lengths are counted in 64 classes of equal width. Every combination of up to three classes that fills a
   window is a pattern. Non-negative least squares finds how often to use each pattern so that the
   classes' counts come out; a class weighs as much as its length, because short pieces are easily placed later.
3. The solution is rounded, and patterns take documents of their classes, as often as there are any.
4. Greedily, the room that is left in a sequence takes the longest residual piece that fits, and then a piece
   cut from the longest residual document, so that planned sequences are full. What remains fills
   whole windows the same way.
5. Fewer tokens than a window are left. They go into sequences as long as the powers of two that
   make up their number, which need no padding.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import cache
from math import inf

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from chatlake.llm.common import id_text
from chatlake.llm.tokens import WordIds

WINDOW = 4096
SEPARATOR = 2
#: Classes of length, and classes in a pattern at most.
CLASSES, DEPTH = 64, 3
#: Tokens and documents of a group at most, but for what its last document adds.
GROUP_TOKENS, GROUP_DOCS = 1 << 22, 1 << 16
#: Words whose ids a task keeps.
KEPT_WORDS = 1 << 19

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def least_squares(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """The x >= 0 for which |a x - b| is least, by the active-set method of Lawson and Hanson."""
    gram, target = a.T @ a, a.T @ b
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    limit = tolerance * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(3 * a.shape[1]):
        slope = np.where(active, -inf, target - gram @ x)
        best = int(slope.argmax())
        if active.all() or slope[best] <= limit:
            break
        active[best] = True
        while True:
            own = np.flatnonzero(active)
            free = np.linalg.lstsq(gram[np.ix_(own, own)], target[own], rcond=None)[0]
            if (free > 0).all():
                break
            # Go towards the free solution until the first part reaches zero, and take that part out.
            low = np.flatnonzero(free <= 0)
            step = (x[own[low]] / np.maximum(x[own[low]] - free[low], 1e-300)).min()
            x[own] += step * (free - x[own])
            gone = own[low][x[own[low]] <= limit * 1e-3 + 1e-12]
            active[gone if len(gone) else own[low[free[low].argmin()]]] = False
            x[~active] = 0
        x[:] = 0
        x[own] = free
    return x


@cache
def patterns(classes: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Combinations of up to `depth` classes, in falling order, that add up to `classes`."""

    def parts(total: int, most: int, depth: int) -> Iterator[tuple[int, ...]]:
        if total == 0:
            yield ()
        elif depth:
            for first in range(min(total, most), 0, -1):
                yield from ((first, *rest) for rest in parts(total - first, first, depth - 1))

    return list(parts(classes, classes, depth))


def repeats(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """How often to use each pattern; `histogram[c - 1]` pieces have class c."""
    found = patterns(len(histogram), depth)
    present = [p for p in found if all(histogram[c - 1] for c in p)]
    if not present:
        return []
    matrix = np.zeros((len(histogram), len(present)))
    for column, pattern in enumerate(present):
        for c in pattern:
            matrix[c - 1, column] += 1
    weight = np.arange(1, len(histogram) + 1) / len(histogram)
    solution = np.rint(least_squares(matrix * weight[:, None], histogram * weight)).astype(int)
    return [(pattern, int(n)) for pattern, n in zip(present, solution) if n]


class _Residual:
    """Pieces `(length, item, start)` in order of length."""

    def __init__(self, pieces: list[tuple[int, int, int]]):
        self.pieces = sorted(pieces)
        self.tokens = sum(piece[0] for piece in pieces)

    def add(self, piece: tuple[int, int, int]) -> None:
        insort(self.pieces, piece)
        self.tokens += piece[0]

    def fill(self, room: int) -> list[tuple[int, int, int]]:
        """Pieces of `room` tokens together, or all there are: the longest that fit, then a cut one."""
        out = []
        while room and self.pieces:
            at = bisect_right(self.pieces, (room, inf, inf)) - 1
            if at >= 0:
                piece = self.pieces.pop(at)
            else:
                length, item, start = self.pieces.pop()
                piece = (room, item, start)
                insort(self.pieces, (length - room, item, start + room))
            out.append(piece)
            room -= piece[0]
            self.tokens -= piece[0]
        return out


def pack(lengths: np.ndarray, window: int = WINDOW, classes: int = CLASSES, depth: int = DEPTH) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces `(length, item, start)` of items shorter than a window.

    Every sequence is a whole window or as long as a power of two. `window` and `classes` are powers of two.
    """
    classes = min(classes, window)
    stacks: list[list[int]] = [[] for _ in range(classes + 1)]
    for item, c in reversed(list(enumerate((-(-lengths * classes // window)).tolist()))):
        stacks[c].append(item)
    histogram = np.array([len(stack) for stack in stacks[1:]])
    planned = []
    for pattern, count in repeats(histogram, depth):
        needs = {c: pattern.count(c) for c in pattern}
        for _ in range(min(count, *(len(stacks[c]) // n for c, n in needs.items()))):
            own = [stacks[c].pop() for c in pattern]
            planned.append([(int(lengths[item]), item, 0) for item in own])
    residual = _Residual([(int(lengths[item]), item, 0) for stack in stacks for item in stack])

    # Those with the most room last: they are the ones taken apart if nothing is left to fill with.
    planned.sort(key=lambda sequence: -sum(piece[0] for piece in sequence))
    out = []
    at, end = 0, len(planned)
    while at < end:
        room = window - sum(piece[0] for piece in planned[at])
        while residual.tokens < room and end > at + 1:
            end -= 1
            for piece in planned[end]:
                residual.add(piece)
        if residual.tokens < room:
            for piece in planned[at]:
                residual.add(piece)
            break
        out.append(planned[at] + residual.fill(room))
        at += 1
    while residual.tokens >= window:
        out.append(residual.fill(window))
    for bit in reversed(range(window.bit_length())):
        if residual.tokens & 1 << bit:
            out.append(residual.fill(1 << bit))
    return out


class _Group:
    """Documents of a task whose sequences are made together."""

    def __init__(self, window: int):
        self.window, self.tokens = window, 0
        self.docs: list[tuple[int | None, np.ndarray]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids))
        self.tokens += len(ids)

    def rows(self, first: int) -> Iterator[tuple]:
        """Rows of SCHEMA; sequences are numbered from `first`."""
        window, number = self.window, first
        heads = [len(ids) // window * window for _, ids in self.docs]
        for (doc_id, ids), head in zip(self.docs, heads):
            for start in range(0, head, window):
                yield doc_id, start, window, ids[start : start + window].tobytes(), len(ids), number, 0
                number += 1
        short = [i for i, ((_, ids), head) in enumerate(zip(self.docs, heads)) if len(ids) > head]
        lengths = np.array([len(self.docs[i][1]) - heads[i] for i in short], np.int64)
        for sequence in pack(lengths, window) if short else []:
            offset = 0
            for length, item, start in sequence:
                (doc_id, ids), start = self.docs[short[item]], heads[short[item]] + start
                yield doc_id, start, length, ids[start : start + length].tobytes(), len(ids), number, offset
                offset += length
            number += 1


def packed_windows(
    docs: DataFrame,
    vocabulary: str,
    window: int = WINDOW,
    separator: int = SEPARATOR,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Every piece of every document with its ids (unsigned 32 bits, little-endian) and its place.

    Null texts are empty; an empty text is its separator alone. Rows with equal ids are documents of
    their own, and a null doc_id stays null. No rows give no rows. Other columns are not read. A
    sequence's number has the task in its upper bits, so a repeated task gives the same sequences. `window`
    is a power of two.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("window has to be a power of two")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, group = WordIds(vocabulary, KEPT_WORDS), _Group(window)
        number = TaskContext.get().partitionId() << 40

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal number, group
            held: list[tuple] = []
            size = 0
            for row in group.rows(number):
                number = row[5] + 1
                held.append(row)
                size += row[2]
                if size >= group_tokens:
                    yield _batch(held)
                    held, size = [], 0
            if held:
                yield _batch(held)
            group = _Group(window)

        for batch in source:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                group.add(doc_id, np.append(words.ids(text.as_py() or ""), np.uint32(separator)).astype("<u4"))
                if group.tokens >= group_tokens or len(group.docs) >= GROUP_DOCS:
                    yield from done()
        yield from done()

    return id_text(docs).mapInArrow(batches, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    kinds = [pa.binary() if name == "ids" else pa.int64() for name in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
