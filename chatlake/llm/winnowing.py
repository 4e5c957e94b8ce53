"""Document fingerprints by winnowing.

Every run of GRAM code points has a rolling hash; of each WINDOW consecutive hashes the least is
chosen, the rightmost of equal ones, and kept with its position. Any passage of
GRAM + WINDOW - 1 code points that two texts share then shares a chosen hash. In short texts grams are at
most half of the text, and windows a quarter of its grams, so that three quarters of any text that stay as they are share a
hash too. Work is done in numpy on portions of a text, so a very long one needs little memory besides itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import id_text, mixed, partitions

GRAM, WINDOW = 24, 41
PORTION = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_FIRST_ID = -(1 << 63)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: Powers for a portion and the grams and windows that reach beyond it.
_UP = _powers(_BASE, PORTION + (1 << 14))
_DOWN = _powers(pow(_BASE, -1, 1 << 64), PORTION + (1 << 14))


def gram_hashes(points: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Rolling polynomial hash, mixed, of each run of `gram` points."""
    n = len(points)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _UP[:n], out=sums[1:])
    return mixed((sums[gram:] - sums[:-gram]) * _DOWN[: n - gram + 1])


def least_in_windows(hashes: np.ndarray, window: int) -> np.ndarray:
    """Position of the least hash, the rightmost of equal ones, in each window of positions."""
    best, width = np.arange(len(hashes)), 1

    def better(left, right):
        return np.where(hashes[left] < hashes[right], left, right)

    while 2 * width <= window:
        best = better(best[:-width], best[width:])
        width *= 2
    if width < window:
        best = better(best[: width - window or None], best[window - width :])
    return best


def scaled(length: int, gram: int = GRAM, window: int = WINDOW) -> tuple[int, int]:
    """Gram and window for a text of so many code points.

    The guarantee between texts stays: the least hash of a window is the least of any shorter one around it, and a
    text that holds a passage of gram + window - 1 points has the full gram if that is twice the gram or more.
    """
    gram = min(gram, max(1, length // 2))
    return gram, min(window, max(1, (length - gram + 1) // 4))


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) chosen from the text, in order of position.

    A text of fewer than `gram` code points has one hash, of the whole of it, and an empty one has none.
    A text of fewer than `window` hashes is one window.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    count = max(1, len(points) - gram + 1)
    gram, window = min(gram, len(points)), min(window, count)
    positions, values = [], []
    for start in range(0, count - window + 1, PORTION):
        part = points[start : start + PORTION + window - 1 + gram - 1]
        hashes = gram_hashes(part, gram)
        chosen = least_in_windows(hashes, window)
        chosen = chosen[np.r_[True, chosen[1:] != chosen[:-1]]]
        if positions and positions[-1][-1] == chosen[0] + start:
            chosen = chosen[1:]
        positions.append(chosen + start)
        values.append(hashes[chosen])
    return np.concatenate(positions), np.concatenate(values)


def digest(positions: np.ndarray, hashes: np.ndarray) -> str:
    both = np.stack([positions.astype("<u8"), hashes.astype("<u8")])
    return hashlib.blake2b(both.tobytes(), digest_size=16).hexdigest()


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Jaccard similarity of the sets of hashes; 1 if both are empty."""
    left, right = np.unique(left), np.unique(right)
    shared = len(np.intersect1d(left, right, assume_unique=True))
    union = len(left) + len(right) - shared
    return shared / union if union else 1.0


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many first ones of the next text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def winnowed(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """`(doc_id, positions, hashes)` of every text; null texts are empty. Other columns are ignored."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = [x.as_py() or "" for x in batch.column("text")]
            found = [winnow(text, *scaled(len(text), gram, window)) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([p for p, _ in found], pa.list_(pa.int64())),
                    pa.array([h.view(np.int64) for _, h in found], pa.list_(pa.int64())),
                ],
                ["doc_id", "positions", "hashes"],
            )

    return id_text(docs).mapInArrow(batches, "doc_id long, positions array<long>, hashes array<long>")


def _dealt_in_order(rows: DataFrame) -> DataFrame:
    """Rows in runs of ids, one run to a partition, each followed by the first row of the next run.

    What reaches the driver is one bound and one first id for each partition.
    """
    parts = partitions(rows.sparkSession)
    shares = [i / parts for i in range(1, parts)]
    bounds = rows.agg(F.percentile_approx("key", shares, 100 * parts).alias("q")).first()["q"] if shares else []
    cuts = np.unique(np.array(bounds or [], np.int64))

    @F.pandas_udf("int")
    def part_of(keys):
        import pandas as pd

        return pd.Series(np.searchsorted(cuts, keys.to_numpy(), side="right").astype(np.int32))

    rows = rows.withColumn("part", part_of("key"))
    first = {r["part"]: r["key"] for r in rows.select("key", "part").groupBy("part").agg(F.min("key").alias("key")).collect()}
    full = sorted(first)
    back = {part: full[i - 1] for i, part in enumerate(full)}
    firsts = F.array(*[F.lit(first.get(p)).cast("long") for p in range(len(cuts) + 1)])
    backs = F.array(*[F.lit(back.get(p)).cast("int") for p in range(len(cuts) + 1)])
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("ahead"))
    copy = F.struct(F.element_at(backs, F.col("part") + 1).alias("part"), F.lit(True).alias("ahead"))
    is_first = F.col("key") == F.element_at(firsts, F.col("part") + 1)
    places = F.when(is_first, F.array(own, copy)).otherwise(F.array(own))
    dealt = rows.withColumn("place", F.explode(places)).select("doc_id", "key", "text", "place.part", "place.ahead")
    return dealt.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "ahead", "key", "text")


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_chosen long"
)


def fingerprints_with_edits(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text of `docs(doc_id, text)` and of the text edited with the next one.

    Next is the row with the next doc_id, rows of equal ids being in order of their text and null ids first; after the
    last comes the first, which for a single row is itself. Grams and windows are `scaled` to each text. Null texts are empty. Two empty texts have likeness
    1, an empty and another one 0. No rows give no rows; other columns are ignored.
    """
    rows = id_text(docs).select(
        "doc_id",
        F.coalesce("doc_id", F.lit(_FIRST_ID)).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def result(now, following):
        doc_id, text, (positions, hashes) = now
        changed = edited(text, following[1])
        own, other = digest(positions, hashes), winnow(changed, *scaled(len(changed), gram, window))
        return (
            doc_id,
            len(text),
            hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            own,
            digest(*other),
            likeness(hashes, other[1]),
            likeness(hashes, following[2][1]),
            len(hashes),
        )

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
        names = [field.split(" ")[0] for field in _RESULT.split(", ")]
        for batch in source:
            out = []
            for doc_id, ahead, value in zip(
                batch.column("doc_id").to_pylist(), batch.column("ahead").to_pylist(), batch.column("text")
            ):
                if ahead and now is None:  # more rows with the id of the next run's first
                    continue
                text = value.as_py()
                row = doc_id, text, winnow(text, *scaled(len(text), gram, window))
                if now is not None:
                    out.append(result(now, row))
                now = None if ahead else row
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return _dealt_in_order(rows).mapInArrow(batches, _RESULT)
