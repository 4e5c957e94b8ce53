"""Quality classifier from weak labels.

Heuristic labellers vote on every document or abstain. Their votes are counted by pattern, at most
3^labellers rows whatever the corpus, and expectation-maximisation on these counts estimates
how often each labeller is right about good and about bad documents, and how likely each pattern makes
a good one. These posteriors label a bounded sample of documents, on which a linear scorer of hashed
byte grams and hashed statistics is trained; the scorer then judges every document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from chatlake.llm.common import discard, id_text, stored

#: Distinct texts that the scorer is trained on at most: those with the smallest hashes.
SAMPLE = 4096
BUCKET_BITS = 15
GRAM = 4
THRESHOLD = 0.5
BAD, GOOD, ABSTAIN = 0, 1, 2

#: Signs that rarely end a word of prose.
MARKS = frozenset("!#$%&*+/<=>@[\\]^_`{|}~")

_BUCKETS = 1 << BUCKET_BITS
_PORTION = 1 << 20


class Statistics(NamedTuple):
    words: int
    symbol_share: float
    upper_share: float
    top_share: float
    twin_share: float
    distinct_share: float
    mean_length: float
    stop_share: float
    line_share: float
    gram_share: float
    marked_share: float


def _shares(items: list) -> float:
    """Share of the items that have occurred before."""
    return 1 - len(set(items)) / len(items) if items else 0.0


def statistics(text: str) -> Statistics:
    words = text.split()
    n = len(words)
    if not n:
        return Statistics(0, *[0.0] * 10)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(data, minlength=256)
    letters = int(kinds[65:91].sum() + kinds[97:123].sum())
    marks = int(kinds[33:39].sum() + kinds[42:44].sum() + kinds[60:65].sum() + kinds[91:97].sum() + kinds[123:127].sum())
    count = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    return Statistics(
        n,
        marks / len(data),
        int(kinds[65:91].sum()) / max(letters, 1),
        count.most_common(1)[0][1] / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(count) / n,
        sum(map(len, words)) / n,
        sum(w[-1] in ".!?…" for w in words) / n,
        _shares(lines),
        _shares(list(zip(words, words[1:], words[2:], words[3:]))),
        sum(w[-1] in MARKS for w in words) / n,
    )


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


def votes(s: Statistics) -> str:
    """One digit for each labeller; texts of a few words leave most of them silent."""
    long, few = s.words >= 20, s.words >= 3
    return "".join(
        map(
            str,
            (
                _vote(s.symbol_share > 0.04, few and s.symbol_share < 0.01),
                _vote(s.marked_share > 0.1, few and s.marked_share < 0.02),
                _vote(s.upper_share > 0.4, few and s.upper_share < 0.2),
                _vote(long and s.top_share > 0.2, long and s.top_share < 0.12),
                _vote(s.words >= 8 and s.twin_share > 0.15, long and s.twin_share < 0.04),
                _vote(few and (s.mean_length > 7.5 or s.mean_length < 2), few and 3.5 <= s.mean_length <= 6.5),
                _vote(long and (s.stop_share > 0.5 or s.stop_share < 0.02), long and 0.03 < s.stop_share < 0.25),
                _vote(s.line_share > 0.3, False),
                _vote(long and s.gram_share > 0.3, long and s.gram_share < 0.05),
            ),
        )
    )


def estimate(patterns: dict[str, int], steps: int = 200) -> dict[str, float]:
    """Probability of good for each pattern of votes, by expectation-maximisation.

    Labellers are taken as independent given the class; each that votes is right at one rate about good
    and at another about bad documents, and abstaining says nothing.
    The first guess holds a document for bad in the measure of the bad votes it has, which also fixes
    which class is which.
    """
    if not patterns:
        return {}
    names = list(patterns)
    counts = np.array([patterns[p] for p in names], float)
    vote = np.array([[int(v) for v in p] for p in names])
    n_bad = (vote == BAD).sum(axis=1)
    good = np.where(n_bad == 0, 0.95, 0.3 ** n_bad)
    one_hot = (vote[:, :, None] == np.arange(2)).astype(float)
    for _ in range(steps):
        of_class = np.stack([counts * (1 - good), counts * good])
        prior = (of_class.sum(axis=1) + 1) / (counts.sum() + 2)
        rates = np.einsum("cp,pjv->cjv", of_class, one_hot) + 1
        rates /= rates.sum(axis=2, keepdims=True)
        score = np.log(prior)[:, None] + np.einsum("cjv,pjv->cp", np.log(rates), one_hot)
        before, good = good, 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
        if np.abs(good - before).max() < 1e-6:
            break
    return dict(zip(names, good.tolist()))


def features(text: str, s: Statistics) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights): hashed byte grams, of length 1 together, and hashed steps of the statistics."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    total = np.zeros(_BUCKETS)
    for start in range(0, max(len(data) - GRAM + 1, 0), _PORTION):
        part = data[start : start + _PORTION + GRAM - 1].astype(np.uint32)
        code = sum(part[i : len(part) - GRAM + 1 + i] << np.uint32(8 * i) for i in range(GRAM))
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
        total += np.bincount(code, minlength=_BUCKETS)
    used = np.flatnonzero(total)
    value = np.sqrt(total[used])
    value /= max(np.sqrt((value**2).sum()), 1e-12)
    steps = [int(np.clip(round(20 * v**0.5), 0, 60)) for v in s[1:6]] + [int(min(s.mean_length, 40))]
    steps += [int(np.clip(round(20 * v**0.5), 0, 60)) for v in s[7:]] + [int(np.log2(s.words + 1))]
    extra = np.array([(97 * i + step) * 2654435761 % (1 << 32) >> (32 - BUCKET_BITS) for i, step in enumerate(steps)])
    return np.concatenate([used, extra]), np.concatenate([value, np.full(len(extra), 0.5)])


class Scorer(NamedTuple):
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        """Probability of good; 0 for a text without words."""
        s = statistics(text)
        if not s.words:
            return 0.0
        buckets, values = features(text, s)
        return float(1 / (1 + np.exp(-np.clip(self.weights[buckets] @ values + self.bias, -50, 50))))


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], steps: int = 150, rate: float = 0.5, decay: float = 1e-5) -> Scorer:
    """Logistic regression on soft labels, by whole-sample gradients with per-weight rates."""
    weights, bias = np.zeros(_BUCKETS), 0.0
    if not rows:
        return Scorer(weights, bias)
    buckets = np.concatenate([r[0] for r in rows])
    values = np.concatenate([r[1] for r in rows])
    labels = np.array([r[2] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    squares, bias_square = np.full(_BUCKETS, 1e-8), 1e-8
    for _ in range(steps):
        score = np.bincount(row, weights[buckets] * values, len(rows)) + bias
        error = 1 / (1 + np.exp(-np.clip(score, -50, 50))) - labels
        gradient = np.bincount(buckets, values * error[row], _BUCKETS) / len(rows) + decay * weights
        squares += gradient**2
        weights -= rate * gradient / np.sqrt(squares)
        bias_square += error.mean() ** 2
        bias -= rate * error.mean() / np.sqrt(bias_square)
    return Scorer(weights, bias)


def voted(docs: DataFrame) -> DataFrame:
    """`(doc_id, pattern)`: the labellers' votes on every text; null texts are empty."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            patterns = [votes(statistics(x.as_py() or "")) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(patterns, pa.string())], ["doc_id", "pattern"])

    return id_text(docs).mapInArrow(batches, "doc_id long, pattern string")


def fit(docs: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Count votes over all documents, estimate, and train on `sample` distinct texts, or all there are.

    Copies of a text are one text here, whatever their number and ids.
    """
    counts = stored(voted(docs).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")))
    patterns = {r["pattern"]: r["n"] for r in counts.collect()}
    discard(counts)
    posterior = estimate(patterns)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = []
            for value in batch.column("text"):
                s = statistics(value.as_py() or "")
                buckets, values = features(value.as_py() or "", s)
                out.append((buckets.astype("<u2").tobytes(), values.astype("<f4").tobytes(), posterior[votes(s)]))
            columns = list(zip(*out))
            kinds = [pa.binary(), pa.binary(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["b", "v", "y"])

    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = id_text(docs).select(text.alias("text"), F.xxhash64(F.lit("sample"), text).alias("h"))
    last = hashed.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    chosen = hashed.filter(F.col("h") <= F.lit(last)).groupBy("h").agg(F.min("text").alias("text"))
    rows = chosen.mapInArrow(batches, "b binary, v binary, y double").collect()
    return train(
        [
            (np.frombuffer(r["b"], "<u2").astype(np.int64), np.frombuffer(r["v"], "<f4").astype(float), r["y"])
            for r in rows
        ]
    )


def scored(docs: DataFrame, scorer: Scorer, name: str = "score") -> DataFrame:
    """`docs` with the scorer's probability that a text is good, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    columns = [c for c in docs.columns if c != name]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for batch in source:
            values = pa.array([scorer.score(x.as_py() or "") for x in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), values], [*columns, name])

    rows = docs.select(*columns).withColumn("text", F.col("text").cast("string"))
    return rows.mapInArrow(batches, StructType([*rows.schema.fields, StructField(name, DoubleType())]))


def judged(docs: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of `docs`, all columns included, with `score` and `kept` (score at least the threshold).

    A null text is empty; a text without words has score 0 and is not kept. Equal texts have
    equal scores, and repeated rows stay repeated. No rows give no rows. Columns named score or kept are replaced.
    """
    docs = docs.select(*[c for c in docs.columns if c not in ("score", "kept")])
    return scored(docs, fit(docs, sample)).withColumn("kept", F.col("score") >= threshold)
