"""Alignment of tokenizers, perfect hashes and tree sums against plain versions."""

from __future__ import annotations

import functools
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chatlake.llm import alignment
from chatlake.llm.perfect_hash import PerfectHash
from chatlake.llm.queries import op13_alignment_of
from chatlake.llm.vector_sums import tree_summed

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(A)
LIBRARY.encode_special_tokens = True
MODEL = sentencepiece.SentencePieceProcessor(model_file=B)


def _letters():
    """The letters of byte-level vocabularies, from the library itself."""
    from tokenizers.pre_tokenizers import ByteLevel

    plain = ByteLevel(add_prefix_space=False, use_regex=False)
    table = {}
    for point in [*range(0x80), *range(0xA0, 0x800), 0x800, *range(0x1000, 0x10000, 0x1000), *range(0x10000, 0x110000, 0x10000)]:
        for letter, byte in zip(plain.pre_tokenize_str(chr(point))[0][0], chr(point).encode()):
            table[letter] = byte
    return table


LETTERS = _letters()


def _plain(text):
    """(ids of A, ids of B, groups) of a text as a whole; None where the bytes are not the text's."""
    if not text:
        return None
    whole = (" " + text).encode()
    encoded = LIBRARY.encode(" " + text, add_special_tokens=False)
    a = encoded.ids
    bytes_a = [bytes(LETTERS[c] for c in token) for token in encoded.tokens]
    b, bytes_b = MODEL.encode(text), []
    for i in b:
        name = MODEL.id_to_piece(i)
        bytes_b.append(bytes([int(name[3:5], 16)]) if MODEL.is_byte(i) else name.replace("▁", " ").encode())
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    ends = [np.cumsum([len(t) for t in tokens]).tolist() for tokens in (bytes_a, bytes_b)]
    groups, from_a, from_b = [], 0, 0
    places = [{end: i + 1 for i, end in enumerate(own)} for own in ends]
    for end in sorted(places[0].keys() & places[1].keys()):
        to_a, to_b = places[0][end], places[1][end]
        groups.append((a[from_a:to_a], b[from_b:to_b]))
        from_a, from_b = to_a, to_b
    return a, b, groups


def _expected(rows):
    found = [(i, _plain(text or "")) for i, text in rows]
    counts = Counter((x[-1], y[-1]) for _, f in found if f for x, y in f[2])
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x[-1], y[-1]) for x, y in f[2]]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[2])
        out.append(
            (i, len(f[0]), len(f[1]), len(f[2]), len(links), sum(counts[p] == best[p[1]] for p in links),
             sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest())
        )
    return Counter(out)


EXTRA = [
    (30, " leading and  double   spaces "),
    (31, "line\n next\n\n  two\tthree\r\n"),
    (32, "a ▁ b"),
    (33, "<s> </s> <unk> <0x41> <|endoftext|>"),
    (34, "x  y \x1c z\x1f w  v　 u\x85 t"),
    (35, "é ́ e‍ \U0001f600️  \U0001f469‍\U0001f680"),
    (36, "ǆ ﬁ ① ㎒ ﻿ mark"),
    (37, " "),
    (38, "don't can't 'tis she's 'S"),
]


def test_documents(spark, docs, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 1000)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + EXTRA
    table = docs.unionByName(
        spark.createDataFrame([(i, t) for i, t in EXTRA], "doc_id long, text string"), allowMissingColumns=True
    )
    assert Counter(tuple(r) for r in op13_alignment_of(table).collect()) == _expected(rows)


def test_no_documents(no_docs):
    assert op13_alignment_of(no_docs).count() == 0


def test_without_any_token(spark):
    empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert [tuple(r)[1:] for r in op13_alignment_of(empty).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


@functools.cache
def _aligner():
    return alignment.Aligner(A, B)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,'ab▁1 \x1c　é日"), st.characters(exclude_categories=["Cs"])), max_size=20), max_size=3))
def test_pieces_of_text_give_what_whole_texts_give(texts):
    aligner = _aligner()
    aligner.forget()
    flat, starts = aligner.add(texts)
    for text, low, high in zip(texts, starts, [*starts[1:], len(flat)]):
        plain, own = _plain(text), flat[low:high]
        if plain is None:
            assert not text or aligner.numbers[own, 3].any()
        else:
            assert aligner.numbers[own].sum(axis=0).tolist() == [*map(len, plain), 0]
            groups = ";".join(aligner.groups[i] for i in own)
            assert groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in plain[2])


def test_forgetting_changes_nothing(docs, monkeypatch):
    before = Counter(tuple(r) for r in op13_alignment_of(docs).collect())
    monkeypatch.setattr(alignment, "KEPT_CHUNKS", 2)
    monkeypatch.setattr(alignment, "PORTION_CHARS", 10)
    assert Counter(tuple(r) for r in op13_alignment_of(docs).collect()) == before


def test_bound_of_pairs():
    a, b = [b"a", b"ba", b"c"], [b"a", b"cba", b"x", b"ba"]
    ends = [(x, y) for x in a for y in b if x.endswith(y) or y.endswith(x)]
    assert alignment.most_pairs(a, b) == len(ends)


@pytest.mark.parametrize("size", [0, 1, 2, 1000, 100_000])
def test_perfect_hash(size):
    keys = np.random.default_rng(size).choice(1 << 50, size, replace=False)
    place = PerfectHash(np.append(keys, keys[:3]))
    assert sorted(place.numbers(keys).tolist()) == list(range(size))
    others = np.setdiff1d(np.arange(1 << 10), keys)
    assert (place.numbers(others) == -1).all()


def test_tree_sums(spark):
    rows = [(k, n, np.array([n, k, 1], "<i8").tobytes()) for k in range(3) for n in range(300) if n % 7]
    found = tree_summed(spark.createDataFrame(rows, "key long, node long, vector binary"), "<i8").collect()
    nodes = [n for n in range(300) if n % 7]
    assert {r.key: np.frombuffer(bytes(r.vector), "<i8").tolist() for r in found} == {
        k: [sum(nodes), k * len(nodes), len(nodes)] for k in range(3)
    }
