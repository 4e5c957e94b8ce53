"""Token counts from the pieces of distinct pre-tokens.

1. Where documents are read, blocks of them become a dictionary of distinct pre-tokens and the
   documents' frequencies over it. Blocks are stored, compressed, about a quarter of the text.
2. The words of each block's dictionary go, sorted and compressed, to the tasks that own them by
   hash. A task counts the pieces of each of its distinct words once and sends back one number for
   each word of each block.
3. The numbers meet the block's frequencies again, and each document's products are summed.

Frequencies never leave their block, and the common words cost each block one entry, so nothing
is skewed by them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import id_text, partitions, stored
from chatlake.llm.tokens import WordPieces

LIMIT = 2048
#: Between the words of a list: white space, which no pre-token holds, as NUL may.
_BREAK = "\n"
#: Code points of text in a block; a longer text is a block of its own.
BLOCK_CHARS = 1 << 23

_BLOCK = "block long, doc_ids array<long>, n_bytes array<long>, starts binary, words binary, counts binary, parts array<int>, lists array<binary>"


def _packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed with the bytes of equal weight together."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Block:
    def __init__(self, parts: int):
        self.parts, self.chars = parts, 0
        self.ids, self.n_bytes, self.starts = [], [], [0]
        self.place: dict[str, int] = {}
        self.words: list[int] = []
        self.counts: list[int] = []

    def add(self, doc_id, text: str, pretokens: list[str]) -> None:
        found, place = Counter(pretokens), self.place
        for word in found:
            if word not in place:
                place[word] = len(place)
        self.words += map(place.__getitem__, found)
        self.counts += found.values()
        self.starts.append(len(self.words))
        self.ids.append(doc_id)
        self.n_bytes.append(len(text.encode("utf-8", "surrogatepass")))
        self.chars += len(text)

    def row(self, number: int) -> pa.RecordBatch:
        """The block, with its words numbered in the order of (owner, word)."""
        words = list(self.place)
        owners = [zlib.crc32(w.encode("utf-8", "surrogatepass")) % self.parts for w in words]
        order = sorted(range(len(words)), key=lambda i: (owners[i], words[i]))
        number_of = np.empty(len(words), np.int64)
        number_of[order] = np.arange(len(words))
        lists: dict[int, list[str]] = {}
        for i in order:
            lists.setdefault(owners[i], []).append(words[i])
        packed = [zstandard.compress(_BREAK.join(v).encode("utf-8", "surrogatepass"), 3) for v in lists.values()]
        numbers = number_of[np.array(self.words, np.int64)] if self.words else np.zeros(0)
        row = {
            "block": number,
            "doc_ids": self.ids,
            "n_bytes": self.n_bytes,
            "starts": _packed(np.array(self.starts)),
            "words": _packed(numbers),
            "counts": _packed(np.array(self.counts)),
            "parts": list(lists),
            "lists": packed,
        }
        return pa.RecordBatch.from_pylist([row], _SCHEMA)


_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_bytes", pa.list_(pa.int64())),
        ("starts", pa.binary()),
        ("words", pa.binary()),
        ("counts", pa.binary()),
        ("parts", pa.list_(pa.int32())),
        ("lists", pa.list_(pa.binary())),
    ]
)


def _blocks(docs: DataFrame, vocabulary: str, block_chars: int) -> DataFrame:
    parts = partitions(docs.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, block = WordPieces(vocabulary), _Block(parts)
        number = TaskContext.get().partitionId() << 32
        for batch in source:
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = value.as_py() or ""
                if block.ids and block.chars + len(text) > block_chars:
                    yield block.row(number)
                    block, number = _Block(parts), number + 1
                block.add(doc_id, text, pieces.pretokens(text))
        if block.ids:
            yield block.row(number)

    return id_text(docs).mapInArrow(batches, _BLOCK)


def _piece_counts(blocks: DataFrame, vocabulary: str) -> DataFrame:
    """`(block, part, pieces)`: the number of pieces of each word of each list."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = WordPieces(vocabulary), {}
        for batch in source:
            out = []
            for data in batch.column("list").to_pylist():
                words = zstandard.decompress(data).decode("utf-8", "surrogatepass").split(_BREAK)
                for word in words:
                    if word not in known:
                        known[word] = pieces.count(word)
                out.append(_packed(np.array([known[w] for w in words])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("part"), pa.array(out, pa.binary())], ["block", "part", "pieces"]
            )

    lists = blocks.select("block", F.explode(F.arrays_zip("parts", "lists")).alias("x")).select(
        "block", F.col("x.parts").alias("part"), F.col("x.lists").alias("list")
    )
    parts = partitions(blocks.sparkSession)
    return lists.repartitionById(parts, F.col("part")).mapInArrow(batches, "block long, part int, pieces binary")


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` of every row of `docs(doc_id, text)`.

    Tokens are those of the word BPE file at `vocabulary`, special strings in a text included. A null
    text is empty and has none. Rows with equal ids are documents of their own; no rows give no rows; other columns are
    ignored.
    """
    blocks = stored(_blocks(docs, vocabulary, block_chars))
    # At most one entry for each partition and block, together a number for each word of the block.
    entries = _piece_counts(blocks, vocabulary).groupBy("block").agg(
        F.collect_list(F.struct("part", "pieces")).alias("entries")
    )
    joined = blocks.select("block", "doc_ids", "n_bytes", "starts", "words", "counts").join(entries, "block", "left")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for row in range(batch.num_rows):
                x = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                lists = [_unpacked(e["pieces"]) for e in sorted(x["entries"] or [], key=lambda e: e["part"])]
                pieces = np.concatenate(lists) if lists else np.zeros(0, np.uint32)
                starts = _unpacked(x["starts"]).astype(np.int64)
                products = pieces[_unpacked(x["words"])].astype(np.int64) * _unpacked(x["counts"])
                sums = np.concatenate([[0], np.cumsum(products)])
                tokens = sums[starts[1:]] - sums[starts[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x["doc_ids"], pa.int64()), pa.array(x["n_bytes"], pa.int64()), pa.array(tokens, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    counted = joined.mapInArrow(batches, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
