"""Embeddings and pages against plain versions."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from chatlake.llm import host_trust, pq
from chatlake.llm.components import connected_components


def _plain_links(rows):
    sound = [i for i, (_, v, k) in enumerate(rows) if k is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = [0] * len(rows)
    label = list(range(len(rows)))
    pairs = []
    for a in sound:
        for b in sound:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a != b and rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93:
                links[a] += 1
                pairs.append((a, b))
    for _ in rows:
        for a, b in pairs:
            label[a] = min(label[a], label[b])
    out = Counter()
    for a, (i, _, _) in enumerate(rows):
        component = min((rows[b][0] for b in range(len(rows)) if label[b] == label[a]))
        out[i, links[a], component, component == i] += 1
    return out


@pytest.mark.parametrize("block,size", [(1024, 512), (3, 4)])
def test_vectors(spark, block, size):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(120):
        base = rng.normal(size=8) if i % 4 == 0 else base  # noqa: F821
        rows.append((i, [float(x) for x in base + rng.normal(size=8) * (i % 4) * 0.12], int(i % 3)))
    rows += [(200, rows[0][1], 0), (200, rows[0][1], 0), (201, [2 * x for x in rows[0][1]], 0), (202, rows[0][1][:4], 0)]
    rows += [(203, None, 0), (204, [0.0] * 8, 0), (205, [1.0, None] + [0.0] * 6, 0), (206, [float("nan")] * 8, 0)]
    rows += [(207, [float("inf")] + [1.0] * 7, 0), (208, rows[0][1], None), (209, [], 0)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    found = pq.near_duplicates(table, list_size=size, block=block).collect()
    assert Counter(map(tuple, found)) == _plain_links(rows)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert pq.near_duplicates(empty).count() == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(500 + i, 501 + i) for i in range(40)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    label = {n: n for p in pairs if p[0] != p[1] for n in p}
    for _ in range(60):
        for a, b in pairs:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found == label


PAGES = [
    (1, "http://A.good.org/x", '<a href="http://friend.net/">'),
    (2, "https://friend.net/y?z#t", "<A HREF='//next.net/p'> <a href=/own>"),
    (3, "http://next.net", None),
    (4, "https://bad.example.org/es/1", ""),
    (5, "https://linker.net/q", '<a href="https://bad.example.org/en"> <a href="http://bad.example.org/">'),
    (6, "http://www.shop.com/fr/a", ""),
    (7, "http://www.shop.com/de/a", ""),
    (8, None, None),
    (9, "no scheme here", "x"),
    (10, "http://example.org/en/12", ""),
    (11, "http://notexample.org/en/12", ""),
    (11, "http://notexample.org/en/12", ""),
    (12, "http://org", ""),
]


def test_pages(spark):
    table = spark.createDataFrame([(*p, 1, "x") for p in PAGES], "page_id long, url string, html string, score int, kind string")
    found = {r.page_id: r for r in host_trust.filtered_urls(table).collect()}
    shown = {i: (r.host, r.path, r.rule, r.verdict) for i, r in found.items()}
    assert shown == {
        1: ("a.good.org", "/x", "org/", "allow"),
        2: ("friend.net", "/y", None, "allow"),
        3: ("next.net", "", None, "allow"),
        4: ("bad.example.org", "/es/1", "example.org/es/", "block"),
        5: ("linker.net", "/q", None, "block"),
        6: ("www.shop.com", "/fr/a", "com/fr/", "allow"),
        7: ("www.shop.com", "/de/a", "com/de/", "block"),
        8: ("", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("example.org", "/en/12", "example.org/en/1", "block"),
        11: ("notexample.org", "/en/12", "org/", "allow"),
        12: ("org", "", None, "allow"),
    }
    assert found[2].trust > found[3].trust > 0 and found[5].distrust > 0.5


def test_ranks_against_a_matrix(spark):
    rng = np.random.default_rng(3)
    links = {(int(a), int(b)): int(n) for a, b, n in rng.integers(1, 9, (30, 3)) if a != b}
    seeds = {"1": 1.0, "2": 0.5}
    frame = spark.createDataFrame([(str(a), str(b), n) for (a, b), n in links.items()], "src string, dst string, n long")
    seed = spark.createDataFrame([("trust", h, s) for h, s in seeds.items()], "kind string, host string, seed double")
    found = {r.host: r.score for r in host_trust.spread(frame, seed, 0.85, 6).collect()}
    move = np.zeros((10, 10))
    for (a, b), n in links.items():
        move[b, a] = n / sum(m for (x, _), m in links.items() if x == a)
    base = np.array([0.15 * seeds.get(str(i), 0) for i in range(10)])
    score = base
    for _ in range(6):
        score = base + 0.85 * move @ score
    assert all(found.get(str(i), 0.0) == pytest.approx(score[i]) for i in range(1, 10))


def test_spread_goes_on_until_nothing_is_added(spark):
    schema = "src string, dst string, n long"
    seed = spark.createDataFrame([("distrust", "a", 1.0)], "kind string, host string, seed double")
    pair = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], schema)
    found = {r.host: r.score / 0.15 for r in host_trust.spread(pair, seed).collect()}
    assert found["a"] == pytest.approx(1 / (1 - 0.85**2), abs=1e-5)
    assert found["b"] == pytest.approx(0.85 / (1 - 0.85**2), abs=1e-5)


def test_distrust_reaches_the_end_of_a_chain(spark):
    pages = [(0, "http://bad.example.org/es/1", "")]
    pages += [(i, f"http://h{i}.net/", f'<a href="http://h{i - 1}.net/">') for i in range(2, 21)]
    pages += [(1, "http://h1.net/", '<a href="http://bad.example.org/">')]
    found = {r.page_id: r for r in host_trust.filtered_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(found[i].distrust == pytest.approx(0.85**i) for i in range(1, 21))
    assert [i for i in range(21) if found[i].verdict == "block"] == list(range(19))


def test_no_pages(spark):
    assert host_trust.filtered_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
