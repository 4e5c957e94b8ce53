"""Whitening against dense linear algebra and exact arithmetic."""

from __future__ import annotations

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from chatlake.llm import whitening
from chatlake.llm.queries import op11_whitening, op11_whitening_of


def _symmetric(values, seed=0):
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    return basis @ np.diag(values) @ basis.T


MATRICES = {
    "spread": _symmetric(np.arange(1, 41) ** 2.0),
    "close": _symmetric(1 + np.arange(40) * 1e-4),
    "equal": _symmetric(np.ones(12) * 5),
    "equal groups": _symmetric([9, 9, 9, 9, 9, 4, 4, 4, 4, 4, 4, 4, 4, 4, 4, 4, 4, 4, 4, 1, 1, 1]),
    "equal at the end": _symmetric([20 - i for i in range(14)] + [3] * 10),
    "one large": _symmetric([1e6] + [1.0] * 19 + [0.5] * 10),
    "low rank": _symmetric([7, 5, 3] + [0] * 20),
    "diagonal": np.diag(np.arange(20.0)),
    "single": np.array([[4.0]]),
    "pair": np.array([[2.0, 1.0], [1.0, 2.0]]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_inertia_counts(name):
    matrix = MATRICES[name]
    values = np.linalg.eigvalsh(matrix)
    gaps = np.r_[values[0] - 1, (values[1:] + values[:-1]) / 2, values[-1] + 1]
    gaps = gaps[[np.abs(values - g).min() > 1e-9 * np.abs(values).max() for g in gaps]]
    form = whitening.tridiagonal(matrix)
    assert whitening.counts_above(form, gaps).tolist() == [int((values > g).sum()) for g in gaps]


@pytest.mark.parametrize("name", MATRICES)
def test_eigenvectors(spark, name):
    matrix = MATRICES[name]
    values, vectors = whitening.leading_eigenvectors(spark, matrix, 16)
    plain = np.linalg.eigvalsh(matrix)[::-1][:16]
    plain = plain[plain > 1e-9 * plain[0]]
    assert len(values) == len(plain)
    norm = np.abs(plain).max()
    np.testing.assert_allclose(values, plain, atol=1e-13 * norm * len(matrix))
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-12 * norm
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-9


def test_nothing_varies(spark):
    assert whitening.leading_eigenvectors(spark, np.zeros((5, 5)), 16)[0].tolist() == []


def _usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def _expected(rows, size):
    """By id: n, deviations, and absolute whitened entries from exact sums and numpy's eigenvectors."""
    kept = [(i, tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)) for i, v in rows if _usable(v) and len(v) == size]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = {x: [float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit}
    matrix = np.array([centred[x] for x in fit])
    covariance = matrix.T @ matrix / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:16], vectors.T[::-1][:16]
    own = values > 1e-9 * values[0]
    values, vectors = values[own], vectors[own]
    out = defaultdict(list)
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        out[i].append((n, deviation, np.abs(np.array(centred[x]) @ vectors.T / np.sqrt(values))))
    return out, values / np.trace(covariance)


def _compare(found, rows, size):
    plain, explained = _expected(rows, size)
    by_row = defaultdict(list)
    for r in found:
        by_row[r.vec_id].append(r)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert 0 <= r.identity_error < 1e-8
    assert len({r.identity_error for r in found}) <= 1
    assert by_row.keys() == plain.keys()
    for i, own in by_row.items():
        assert sorted(r.component for r in own) == sorted([*range(1, len(explained) + 1)] * len(plain[i]))
        for n, deviation, entries in plain[i]:
            same = [r for r in own if r.deviation == deviation]
            assert same and {r.n for r in same} == {n}
            for c, entry in enumerate(entries, 1):
                assert any(abs(abs(r.whitened) - entry) < 1e-7 for r in same if r.component == c)


def _table(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, n int, x string")


@pytest.mark.parametrize("size", [3, 24])
def test_vectors(spark, size):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=size) * (1 + np.arange(size))]) for i in range(200)]
    rows += [(300, rows[0][1]), (300, rows[0][1]), (300, rows[1][1]), (None, rows[2][1])] + [(400 + i, rows[5][1]) for i in range(90)]
    rows += [(500, None), (501, []), (502, [None] * size), (503, [float("nan")] * size), (504, [float("-inf")] * size)]
    rows += [(505, [1.0] * (size + 1)), (506, [-1e-300] * size), (507, [0.015625] * size)]
    _compare(op11_whitening_of(_table(spark, rows).repartition(7)).collect(), rows, size)


def test_the_whole_test_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    _compare(op11_whitening(spark, folder).collect(), rows, 64)


def test_few_dimensions_vary(spark):
    rows = [(i, [float(i % 7), 2.0, float(i % 7), float(i % 5)]) for i in range(70)]
    found = op11_whitening_of(_table(spark, rows)).collect()
    assert {r.component for r in found} == {1, 2}
    _compare(found, rows, 4)


def test_large_entries(spark):
    rows = [(i, [float(i) * 2.0**40, float(-i * i)]) for i in range(5)] + [(9, [1e300, 0.0])]
    found = op11_whitening_of(_table(spark, rows)).collect()
    assert {r.vec_id for r in found} == set(range(5))
    assert all(r.deviation is None for r in found if r.vec_id in (0, 4))


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    assert op11_whitening_of(_table(spark, rows)).count() == 0
