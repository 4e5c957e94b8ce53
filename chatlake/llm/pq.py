"""Embedding near-duplicates by product quantisation, without loss.

Equal vectors of a label are one node. The model, coarse centroids and codebooks of residuals in
subspaces, is trained on a bounded sample; every node is indexed. On unit vectors a cosine of at
least t is a distance of at most r = sqrt(2 - 2t), so:

- probes: x probes each cell whose half-space, seen from its own centroid, is at most r away. Vectors
  within r of x can be in no other cell.
- tables: from x's squared distances to the codes of each subspace, the distance to a member's
  code is a sum of look-ups. It differs from the true distance by at most the member's own
  quantisation error, which is stored, so members with look-up distance above r + error are out.
- rerank: the rest are compared by the cosine of the vectors themselves in double precision.

Inverted lists are cut into blocks by hash; each pair of a block of members and a block of probing vectors
is a group, so no group grows with a list. A group returns counts and a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import discard, stored, whole_groups
from chatlake.llm.components import connected_components
from chatlake.llm.simhash import _join

COSINE = 0.93
#: Nodes that the model is trained on: those with the smallest hashes.
SAMPLE = 8192
SUBSPACES, CODES, ROUNDS = 8, 64, 6
LIST, MAX_CELLS = 512, 1024
BLOCK = 1024
_SLACK = 1e-6


class Model(NamedTuple):
    cells: np.ndarray
    books: list[np.ndarray]
    edges: list[int]

    def assign(self, unit: np.ndarray, radius: float):
        """(cell, codes, quantisation error, probed cells as a matrix) of unit vectors."""
        square = _squares(unit, self.cells)
        cell = square.argmin(axis=1)
        residual = unit - self.cells[cell]
        codes, coded = [], np.zeros_like(residual)
        for book, low, high in zip(self.books, self.edges, self.edges[1:]):
            code = _squares(residual[:, low:high], book).argmin(axis=1)
            codes.append(code)
            coded[:, low:high] = book[code]
        error = np.sqrt(((residual - coded) ** 2).sum(axis=1))
        own = square[np.arange(len(unit)), cell]
        between = np.sqrt(np.maximum(_squares(self.cells, self.cells), 1e-30))
        away = (square - own[:, None]) / (2 * between[cell])
        probed = away <= radius + _SLACK
        probed[np.arange(len(unit)), cell] = True
        return cell, np.stack(codes, axis=1).astype(np.uint8), error, probed

    def distances(self, unit: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Look-up distances of unit vectors (rows) to coded members of a cell (columns)."""
        residual, total = unit - self.cells[cell], np.zeros((len(unit), len(codes)))
        for i, (book, low, high) in enumerate(zip(self.books, self.edges, self.edges[1:])):
            total += _squares(residual[:, low:high], book)[:, codes[:, i]]
        return np.sqrt(np.maximum(total, 0))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(axis=1)[:, None] - 2 * a @ b.T + (b**2).sum(axis=1), 0)


def _means(points: np.ndarray, count: int, rounds: int = ROUNDS, seed: int = 42) -> np.ndarray:
    """Lloyd's algorithm from distinct starting points; empty clusters keep their centre."""
    distinct = np.unique(points, axis=0)
    count = min(count, len(distinct))
    centres = distinct[np.random.default_rng(seed).choice(len(distinct), count, replace=False)]
    for _ in range(rounds):
        near = _squares(points, centres).argmin(axis=1)
        sizes = np.bincount(near, minlength=count)
        sums = np.stack([np.bincount(near, points[:, d], count) for d in range(points.shape[1])], axis=1)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def train(sample: np.ndarray, cells: int, subspaces: int = SUBSPACES, codes: int = CODES) -> Model:
    """From unit vectors, padded with zeros to a common width."""
    centres = _means(sample, cells)
    residual = sample - centres[_squares(sample, centres).argmin(axis=1)]
    width = sample.shape[1]
    edges = sorted({width * i // subspaces for i in range(subspaces + 1)})
    books = [_means(residual[:, low:high], codes) for low, high in zip(edges, edges[1:])]
    return Model(centres, books, edges)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, padded with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy().astype(np.float64)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Times a power of two, so exactly in proportion, with the largest entry between 0.5 and 1: squares of the
    largest and the smallest doubles would else be infinite or zero."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def compare(model: Model, cell: int, queries: np.ndarray, members: np.ndarray, codes, error, cosine: float):
    """(query, member) of all pairs with at least the cosine."""
    unit = _unit(queries)
    radius = sqrt(2 - 2 * cosine)
    near = model.distances(unit, cell, codes) <= radius + error[None, :] + _SLACK
    left, right = np.nonzero(near)
    if not len(left):
        return left, right
    queries, members = _scaled(queries), _scaled(members)
    scale_q = np.sqrt((queries**2).sum(axis=1))
    scale_m = np.sqrt((members**2).sum(axis=1))
    found = np.zeros(len(left), bool)
    for low in range(0, len(left), 1 << 15):
        i, j = left[low : low + (1 << 15)], right[low : low + (1 << 15)]
        found[low : low + (1 << 15)] = (queries[i] * members[j]).sum(axis=1) >= cosine * scale_q[i] * scale_m[j]
    return left[found], right[found]


def _index(nodes: DataFrame, model: Model, width: int, cosine: float) -> DataFrame:
    radius = sqrt(2 - 2 * cosine)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                cell, codes, error, probed = model.assign(_unit(_matrix(part.column("vector"), width)), radius)
                columns = {
                    "cell": pa.array(cell.astype(np.int32)),
                    "codes": pa.array([c.tobytes() for c in codes], pa.binary()),
                    "error": pa.array(error),
                    "probes": pa.array([np.flatnonzero(p).astype(np.int32) for p in probed], pa.list_(pa.int32())),
                }
                yield pa.RecordBatch.from_arrays([*part.columns, *columns.values()], [*part.schema.names, *columns])

    schema = ", ".join(f"{n} {k}" for n, k in nodes.dtypes)
    return nodes.mapInArrow(batches, f"{schema}, cell int, codes binary, error double, probes array<int>")


def _dealt(indexed: DataFrame, block: int) -> DataFrame:
    """Members and probing vectors in groups `g` of one list, member block and query block."""
    lists = stored(
        indexed.groupBy("label", "size", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("label", "size", "cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    body = ["node", "copies", "vector", "label", "size"]
    member = indexed.select(*body, "codes", "error", "cell", F.lit(True).alias("is_member"))
    query = indexed.select(
        *body, F.lit(None).cast("binary").alias("codes"), F.lit(0.0).alias("error"),
        F.explode("probes").alias("cell"), F.lit(False).alias("is_member"),
    )
    both = member.unionByName(query).join(lists, ["label", "size", "cell"])
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    both = both.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = F.when(F.col("is_member"), F.struct("own", "other")).otherwise(
        F.struct(F.col("other").alias("own"), F.col("own").alias("other"))
    )
    return both.select(*body, "codes", "error", "cell", "is_member", F.xxhash64("label", "size", "cell", blocks).alias("g"))


def _links(dealt: DataFrame, model: Model, width: int, cosine: float) -> DataFrame:
    """`(node, other, links)`: counts of linked vectors, other being null, and edges of forests."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(source, "g"):
            groups = table.column("g").to_numpy()
            edges = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1], True])
            for low, high in zip(edges, edges[1:]):
                part = table.slice(low, high - low)
                is_member = part.column("is_member").to_numpy()
                if is_member.all() or not is_member.any():
                    continue
                # Lists whose hashes fall together would differ in these; then they are told apart.
                keys = list(zip(*(part.column(c).to_pylist() for c in ("label", "size", "cell"))))
                for key in set(keys):
                    same = np.array([k == key for k in keys])
                    yield group(part.filter(pa.array(same)), key[2])

    def group(part: pa.Table, cell: int) -> pa.RecordBatch:
        is_member = part.column("is_member").to_numpy()
        vectors = _matrix(part.column("vector"), width)
        node, copies = part.column("node").to_numpy(), part.column("copies").to_numpy()
        m, q = np.flatnonzero(is_member), np.flatnonzero(~is_member)
        if not len(m) or not len(q):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, ["node", "other", "links"])
        codes = np.frombuffer(b"".join(part.column("codes").take(pa.array(m)).to_pylist()), np.uint8).reshape(len(m), -1)
        error = part.column("error").to_numpy()[m]
        i, j = compare(model, cell, vectors[q], vectors[m], codes, error, cosine)
        apart = node[q][i] != node[m][j]
        i, j = i[apart], j[apart]
        counts = np.bincount(i, copies[m][j], len(q)).astype(np.int64)
        names, place = np.unique(node, return_inverse=True)
        label = np.arange(len(names))
        _join(label, place[q][i], place[m][j])
        child = np.flatnonzero(label != np.arange(len(label)))
        some = np.flatnonzero(counts)
        columns = [
            pa.array(np.r_[node[q][some], names[child]], pa.int64()),
            pa.array([None] * len(some) + names[label[child]].tolist(), pa.int64()),
            pa.array(np.r_[counts[some], np.zeros(len(child), np.int64)], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["node", "other", "links"])

    return dealt.repartition("g").sortWithinPartitions("g").mapInArrow(batches, "node long, other long, links long")


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, list_size: int = LIST, block: int = BLOCK
) -> DataFrame:
    """`vec_id, n_links, component_id, kept` of every row of `vectors(vec_id, embedding, label)`.

    Linked are rows of one label whose vectors are of one length and have at least the cosine.
    Rows with a null label, and vectors that are null, empty, zero or hold null or non-finite components, have no link and
    are components of their own. n_links counts rows, so copies count. component_id is the smallest vec_id that links reach,
    the row's own included, and kept tells whether it is its own. Repeated rows link with each other. A null vec_id is no
    component's id unless all its ids are null. No rows give no rows; other columns are ignored.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("vector"), "label")
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    sound = F.coalesce(F.col("label").isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))
    nodes = stored(
        rows.filter(sound)
        .groupBy("label", "vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
        .select(F.monotonically_increasing_id().alias("node"), "label", F.size("vector").alias("size"), "vector", "copies", "first")
    )
    shape = nodes.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("labels"), F.max("size").alias("width")).first()
    width = shape["width"] or 1
    cells = min(MAX_CELLS, max(1, ceil(shape["n"] / max(shape["labels"], 1) / list_size)))
    chosen = nodes.orderBy(F.xxhash64("vector"), "node").limit(sample).select("vector").toArrow()
    model = train(_unit(_matrix(chosen.column("vector"), width)), cells) if chosen.num_rows else Model(np.zeros((1, 1)), [], [0, 1])
    indexed = stored(_index(nodes.select("node", "copies", "vector", "label", "size"), model, width, cosine))
    links = stored(_links(_dealt(indexed, block), model, width, cosine))
    roots = connected_components(links.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = stored(links.groupBy("node").agg(F.sum("links").alias("links")))
    rooted = stored(
        nodes.select("node", "first").join(roots, "node", "left").select("node", "first", F.coalesce("component", "node").alias("root"))
    )
    least = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    result = stored(
        nodes.join(counts, "node", "left")
        .join(rooted.join(least, "root").select("node", "component_id"), "node")
        .select("label", "vector", "copies", F.coalesce("links", F.lit(0)).alias("links"), "component_id")
    )
    discard(indexed, links, roots, counts, rooted, least, nodes)
    keyed = rows.select("vec_id", F.when(sound, x).alias("vector"), F.when(sound, F.col("label")).alias("label"))
    joined = keyed.join(result, ["label", "vector"], "left")
    component = F.when(F.col("copies").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
