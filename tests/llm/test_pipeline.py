"""The pipeline's decisions by row, and the sample of the quality classifier."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from chatlake.llm import quality
from tests.llm.test_documents import _plain_simhash

FOLDER = "/root/testdata/sf0.001"
SPAM = "CLICK HERE!!! $$$ buy now buy now buy now !!! @@@ ### free free free $$$ click click !!!"
PROSE = "The committee met in the old hall and heard what had been found by those who went to look for the missing boat. "


def _plain_kept(rows):
    """The rows, by place, that stay: the first by id (null last) and place of each group of fingerprints."""
    prints = [_plain_simhash(text) for _, text in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                group[root(i)] = root(j)
    best = {}
    for place, (doc_id, _) in enumerate(rows):
        order = (doc_id is None, doc_id or 0, place)
        best[root(place)] = min(best.get(root(place), order), order)
    return Counter(rows[place] for *_, place in best.values())


def _kept(spark, docs):
    found = corpus_pipeline.one_of_each_group(spark, docs, FOLDER)
    assert found.columns == docs.columns
    return Counter((r.doc_id, r.text) for r in found.collect())


def test_one_row_of_each_group_stays(spark):
    a, b, c = (" ".join(f"{letter}{n}" for n in range(60)) for letter in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, b), (None, "alone"), (None, "alone"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = _kept(spark, docs)
    assert found == Counter([(1, a), (2, b), (3, c), (None, "alone"), (4, None)]) == _plain_kept(rows)


def test_groups_of_awkward_rows(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert _kept(spark, docs) == _plain_kept(rows)


def test_groups_of_the_test_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert _kept(spark, docs) == _plain_kept([(r.doc_id, r.text) for r in docs.collect()])


def test_columns_named_like_the_operators_keep_their_values(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name in ("score", "kept", "row", "pattern", "group", "h"):
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} "), "doc_id"))
    rows = {tuple(r) for r in docs.collect()}
    for stage in (corpus_pipeline.good_documents, corpus_pipeline.one_of_each_group):
        found = [tuple(r) for r in stage(spark, docs, FOLDER).collect()]
        assert len(found) > 100 and set(found) <= rows


def test_copies_get_one_verdict_whatever_their_ids(spark):
    def judged(first):
        rows = [(first + i, SPAM) for i in range(3000)] + [(first + 5000 + i, PROSE * (1 + i % 9) + f"It was day {i}.") for i in range(200)]
        found = quality.judged(spark.createDataFrame(rows, "doc_id long, text string"), sample=64)
        return {(r.text, r.score, r.kept) for r in found.collect()}

    first = judged(0)
    assert first == judged(1 << 40)
    assert {kept for text, _, kept in first if text == SPAM} == {False}


def test_the_sample_is_distinct_and_bounded(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(quality, "train", lambda rows: sizes.append(len(rows)) or quality.Scorer(quality.np.zeros(1 << 15), 0.0))
    rows = [(i, f"text {i % 50}") for i in range(400)] + [(1, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for sample in (1, 20, 1000):
        quality.fit(docs, sample)
    assert sizes == [1, 20, 51]
