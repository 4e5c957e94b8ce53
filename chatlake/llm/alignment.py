"""Alignment of two tokenizers' tokens, and how often each pair of ids is linked in the corpus.

A text with a space before it is cut by both tokenizers. Where tokens of both end at the same byte
the text falls into groups, and the two tokens that end there are linked.

Texts are taken apart before spaces that follow a character other than white space: neither
tokenizer has a token across such a place, so a piece of text is aligned once in a task and looked up
after that.

1. Each task aligns its documents and counts its id pairs.
2. The distinct pairs get numbers from a minimal perfect hash. Linked tokens end in the same bytes, so
   one is a suffix of the other; the vocabularies alone bound the number of such pairs
   (`most_pairs`), however large the corpus is, and the hash and the counts can go to every task.
3. Each task's counts become a dense vector indexed by the hash, and the vectors are summed in a tree.
4. The documents are aligned again, and each link looks up its pair's count; keys are verified.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import discard, id_text, stored
from chatlake.llm.perfect_hash import PerfectHash
from chatlake.llm.tokens import _ranks
from chatlake.llm.vector_sums import tree_summed

#: Code points that are aligned together, and distinct pieces of text that a task keeps.
PORTION_CHARS, KEPT_CHUNKS = 1 << 22, 1 << 18
#: Entries in a row of the dense vectors.
BLOCK = 1 << 16
_SPACE = "▁"
#: Before spaces that follow a character other than white space and come before one other than a space.
_CUT = re.compile(r"(?<=\S)(?= +[^ ])")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@functools.cache
def _pieces_model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE file; special tokens are left out."""
    encoding = _ranks(path)
    return [encoding.decode_single_token_bytes(i) for i in range(encoding.n_vocab)]


def piece_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a sentence piece file."""
    model = _pieces_model(path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    found = [_BYTE_PIECE.fullmatch(name) for name in names]
    return [bytes([int(m[1], 16)]) if m else n.replace(_SPACE, " ").encode() for m, n in zip(found, names)]


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many pairs of ids can end together: those of which one's bytes are a suffix of the other's."""
    of_a, of_b = Counter(a), Counter(b)
    longer_a = sum(n * of_b[t[i:]] for t, n in of_a.items() for i in range(len(t)))
    longer_b = sum(n * of_a[t[i:]] for t, n in of_b.items() for i in range(1, len(t)))
    return longer_a + longer_b


class Aligner:
    """Alignments of pieces of text, each made once; they are numbered in order of appearance."""

    def __init__(self, a_path: str, b_path: str, texts: bool = True):
        self.a, self.b = _ranks(a_path), _pieces_model(b_path)
        self.a_bytes, self.b_bytes = byte_level_tokens(a_path), piece_tokens(b_path)
        self.a_lengths, self.b_lengths = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        self.texts = texts
        #: A token as text within a group and at the end of its side.
        self.texts_a, self.texts_b = (
            np.array([[f"{i}{mark}" for i in range(n)] for mark in marks], object)
            for n, marks in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))
        )
        names = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        self.cuts = not any(re.search(f"[^{_SPACE}]{_SPACE}", name) for name in names)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        #: By number: tokens of both, groups, and whether the tokens' bytes are not the text's.
        self.numbers = np.zeros((0, 4), np.int64)
        self.groups: list[str] = []
        #: Linked pairs and the number they belong to.
        self.pairs, self.owners = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the pieces of all texts in order, where each text starts in them)."""
        place, new, flat, starts = self.place, [], [], [0]
        for text in texts:
            chunks = _CUT.split(" " + text) if self.cuts else [" " + text]
            for chunk in set(chunks):
                if chunk not in place:
                    place[chunk] = len(place)
                    new.append(chunk)
            flat.extend(map(place.__getitem__, chunks))
            starts.append(len(flat))
        if new:
            self._align(new)
        return np.array(flat, np.int64), np.array(starts[:-1], np.int64)

    def _align(self, chunks: list[str]) -> None:
        whole = [chunk.encode() for chunk in chunks]
        ids_a = [self.a.encode_ordinary(chunk) for chunk in chunks]  # a byte-level vocabulary loses nothing
        ids_b = self.b.encode([chunk[1:] for chunk in chunks], num_threads=1)
        (a, n_a), (b, n_b) = _flat(ids_a), _flat(ids_b)
        sound = np.ones(len(chunks), bool)
        if not self._gives(b, n_b, whole):
            table = self.b_bytes.__getitem__
            sound = np.array([b"".join(map(table, ids)) == own for ids, own in zip(ids_b, whole)])
            (a, n_a), (b, n_b) = (_flat([i if ok else [] for i, ok in zip(ids, sound)]) for ids in (ids_a, ids_b))
        # Both sides cover the same bytes of every piece, so ends are compared over all of them at once.
        end_a, end_b = self.a_lengths[a].cumsum(), self.b_lengths[b].cumsum()
        last_a, last_b = _found(end_a, end_b), _found(end_b, end_a)
        owner = np.repeat(np.arange(len(chunks)), n_a)[last_a]
        self.pairs = np.concatenate([self.pairs, a[last_a] << 32 | b[last_b]])
        self.owners = np.concatenate([self.owners, owner + len(self.groups)])
        n_groups = np.bincount(owner, minlength=len(chunks))
        self.numbers = np.concatenate([self.numbers, np.stack([n_a, n_b, n_groups, ~sound], axis=1)])
        self.groups += self._texts(a, b, last_a, last_b, n_a + n_b) if self.texts else [""] * len(chunks)

    def _gives(self, ids: np.ndarray, counts: np.ndarray, whole: list[bytes]) -> bool:
        """Whether the tokens of all pieces together are the pieces' bytes, and of each as many as it has."""
        reached = np.append(0, self.b_lengths[ids].cumsum())
        ends = counts.cumsum()
        if not np.array_equal(reached[ends] - reached[ends - counts], [len(piece) for piece in whole]):
            return False
        return b"".join(map(self.b_bytes.__getitem__, ids.tolist())) == b"".join(whole)

    def _texts(self, a, b, last_a, last_b, sizes) -> list[str]:
        """Each piece's groups as text, put together from prepared texts of single tokens."""
        group_a, group_b = (last.cumsum() - last for last in (last_a, last_b))
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        texts = np.concatenate([self.texts_a[last_a.astype(int), a], self.texts_b[last_b.astype(int), b]])[order].tolist()
        ends = sizes.cumsum().tolist()
        return ["".join(texts[low:high])[:-1] for low, high in zip([0, *ends], ends)]


def _found(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of the rising values are among others that rise."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, and how many each list has."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, sizes.sum()), sizes


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of parts of a batch that are bounded in text; null is empty."""
    texts, first, size = [], 0, 0
    for row, value in enumerate(batch.column("text")):
        text = value.as_py() or ""
        if texts and size + len(text) > PORTION_CHARS:
            yield first, texts
            texts, first, size = [], row, 0
        texts.append(text)
        size += len(text)
    if texts:
        yield first, texts


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of rows between the starts; every text has a piece, so none is empty."""
    return np.add.reduceat(values, starts, axis=0)


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """`pairs array<long>, counts array<long>`: each task's distinct id pairs and its links of each."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, total = Aligner(a_path, b_path, texts=False), Counter()
        counts = np.zeros(0, np.int64)

        def flush():
            found, at = np.unique(aligner.pairs, return_inverse=True)
            sums = np.zeros(len(found), np.int64)
            np.add.at(sums, at, counts[aligner.owners])
            total.update({p: n for p, n in zip(found.tolist(), sums.tolist()) if n})

        for batch in source:
            for _, texts in _portions(batch):
                flat, starts = aligner.add(texts)
                counts = np.pad(counts, (0, len(aligner.groups) - len(counts)))
                unsound = _sums(aligner.numbers[flat, 3], starts) > 0
                sizes = np.diff(np.append(starts, len(flat)))
                counts += np.bincount(flat[np.repeat(~unsound, sizes)], minlength=len(counts))
                if len(aligner.groups) > KEPT_CHUNKS:
                    flush()
                    aligner.forget()
                    counts = np.zeros(0, np.int64)
        flush()
        if total:
            pairs = sorted(total)
            columns = [pa.array([pairs], pa.list_(pa.int64())), pa.array([[total[p] for p in pairs]], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["pairs", "counts"])

    return id_text(docs).mapInArrow(batches, "pairs array<long>, counts array<long>")


class PairCounts(NamedTuple):
    """Counts of the pairs of a corpus by number, and whether a pair has its B id's highest count."""

    place: PerfectHash
    counts: np.ndarray
    best: np.ndarray

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.place.numbers(pairs)
        if (at < 0).any():
            raise RuntimeError("a pair was not seen when pairs were counted: the documents have changed")
        return self.counts[at], self.best[at]


def summed_counts(partial: DataFrame, bound: int) -> PairCounts:
    """Pairs numbered by a perfect hash, their counts summed as dense vectors.

    `bound` is the most distinct pairs there can be, and what the driver may receive.
    """
    distinct = partial.select(F.explode("pairs").alias("pair")).distinct().limit(bound + 1).toArrow()
    if distinct.num_rows > bound:
        raise ValueError(f"more than {bound} distinct pairs")
    place = PerfectHash(distinct.column("pair").to_numpy())

    def dense(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(place), np.int64)
        for batch in source:
            pairs, counts = (batch.column(name).flatten().to_numpy() for name in ("pairs", "counts"))
            at = place.numbers(pairs)
            if (at < 0).any():
                raise RuntimeError("a pair has no number")
            np.add.at(total, at, counts)
        if total.any():
            node = TaskContext.get().partitionId()
            blocks = range(0, len(total), BLOCK)
            rows = [(i // BLOCK, node, total[i : i + BLOCK].tobytes()) for i in blocks]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "node", "vector"])

    vectors = partial.mapInArrow(dense, "key long, node long, vector binary")
    blocks = sorted(tuple(row) for row in tree_summed(vectors, "<i8").collect())
    counts = np.frombuffer(b"".join(bytes(vector) for _, vector in blocks), "<i8")
    id_b = place.keys & 0xFFFFFFFF
    highest = np.zeros(int(id_b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, id_b, counts)
    return PairCounts(place, counts, counts == highest[id_b])


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Each document's alignment and what the corpus says about its links.

    `doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum` as long and `groups` as text: groups of ids
    `a1,a2|b1;a3|b2,b3` in order. `n_best` are links whose pair has the highest count of its B id,
    ties included; `count_sum` adds up the counts of all links. Empty and null texts, and texts that a
    tokenizer does not give back byte for byte, have zeros and an empty `groups`, and count nothing.
    Rows with equal ids are documents of their own, null ids stay; no rows give no rows. Other
    columns are not read.
    """
    docs = id_text(docs)
    partial = stored(pair_counts(docs, a_path, b_path))
    found = summed_counts(partial, most_pairs(byte_level_tokens(a_path), piece_tokens(b_path)))
    discard(partial)
    known = docs.sparkSession.sparkContext.broadcast(found)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, pair_counts = Aligner(a_path, b_path), known.value
        stats = np.zeros((0, 6), np.int64)
        for batch in source:
            for first, texts in _portions(batch):
                before = len(aligner.groups)
                pairs_before = len(aligner.pairs)
                flat, starts = aligner.add(texts)
                stats = np.concatenate([stats, _stats(aligner, before, pairs_before, pair_counts)])
                sums = _sums(stats[flat], starts)
                sound = (_sums(aligner.numbers[flat, 3], starts) == 0) & np.array([t != "" for t in texts])
                sums[~sound] = 0
                ends = [*starts[1:].tolist(), len(flat)]
                names, at = aligner.groups, flat.tolist()
                groups = [
                    ";".join(map(names.__getitem__, at[low:high])) if ok else ""
                    for low, high, ok in zip(starts.tolist(), ends, sound.tolist())
                ]
                columns = [batch.column("doc_id").slice(first, len(texts)), *map(pa.array, sums.T.copy()), pa.array(groups)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *_COUNTS, "groups"])
                if len(aligner.groups) > KEPT_CHUNKS:
                    aligner.forget()
                    stats = np.zeros((0, 6), np.int64)

    fields = [f"{name} long" for name in ("doc_id", *_COUNTS)]
    return docs.mapInArrow(batches, ", ".join([*fields, "groups string"]))


def _stats(aligner: Aligner, before: int, pairs_before: int, known: PairCounts) -> np.ndarray:
    """The six numbers of the pieces of text that are new; pairs of unsound texts may be unknown."""
    new = aligner.numbers[before:]
    owners = aligner.owners[pairs_before:] - before
    at = known.place.numbers(aligner.pairs[pairs_before:])
    counts = np.append(known.counts, 0)[at]
    best = np.append(known.best, False)[at]
    out = np.zeros((len(new), 6), np.int64)
    out[:, :3] = new[:, :3]
    np.add.at(out[:, 3], owners, 1)
    np.add.at(out[:, 4], owners, best)
    np.add.at(out[:, 5], owners, counts)
    return out
