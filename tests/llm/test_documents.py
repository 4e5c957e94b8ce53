"""Operators on documents against plain versions, on awkward rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from chatlake.llm import hilbert, mixing, packing, quality, simhash, suffix_dedup, token_counts, tokens, winnowing
from tests.llm.conftest import LONG, PASSAGE, ROWS

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
FOLDER = "/root/testdata/sf0.001"


def _library(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


# winnowing ---------------------------------------------------------------------------------


def _plain_winnow(text, gram, window):
    """Chosen positions by comparing every window, with the operator's hashes of single grams."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if len(points) < gram:
        return [0] if len(points) else []
    hashes = [int(winnowing.gram_hashes(points[i : i + gram], gram)[0]) for i in range(len(points) - gram + 1)]
    window = min(window, len(hashes))
    chosen = set()
    for start in range(len(hashes) - window + 1):
        part = hashes[start : start + window]
        chosen.add(start + max(i for i, h in enumerate(part) if h == min(part)))
    return sorted(chosen)


@pytest.mark.parametrize("text", ["", "abc", "abcdefghij" * 7, "aaaa" * 30, "Grüße 日本語 " * 9])
def test_winnow_chooses_the_rightmost_least_hash(text):
    positions, hashes = winnowing.winnow(text, 5, 7)
    assert positions.tolist() == _plain_winnow(text, 5, 7)
    assert len(hashes) == len(positions)


def test_winnow_guarantee_and_portions(monkeypatch):
    rng = random.Random(3)
    shared = "".join(rng.choice("abcd ") for _ in range(winnowing.GRAM + winnowing.WINDOW - 1))
    left, right = ("".join(rng.choice("efgh ") for _ in range(500)) for _ in "ab")
    found = [set(winnowing.winnow(side + shared + side)[1].tolist()) for side in (left, right)]
    assert found[0] & found[1]
    whole = winnowing.winnow(LONG)
    monkeypatch.setattr(winnowing, "PORTION", 1000)
    parts = winnowing.winnow(LONG)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_edited_texts(docs):
    found = winnowing.fingerprints_with_edits(docs).collect()
    order = sorted(((-1 if i is None else i), t or "") for i, t, _, _ in ROWS)
    expected = []
    for at, (i, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        quarter = len(text) // 4
        sha = hashlib.sha256((text[: len(text) - quarter] + following[:quarter]).encode()).hexdigest()
        expected.append((i, len(text), sha))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in found) == sorted(expected)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    same = defaultdict(set)
    for r in found:
        same[r.doc_id].add(r.fingerprint)
    assert same[1] == same[2] and same[4] < same[5]


def test_a_single_text_is_its_own_next(docs):
    row = winnowing.fingerprints_with_edits(docs.filter("doc_id = 4")).collect()[0]
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"one two thone").hexdigest()


def _plain_hashes(text):
    """The set of chosen hashes, gram by gram, with the gram and window of the text's length."""
    gram = min(winnowing.GRAM, max(1, len(text) // 2))
    window = min(winnowing.WINDOW, max(1, (len(text) - gram + 1) // 4))
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return {int(winnowing.gram_hashes(points[i : i + gram], gram)[0]) for i in _plain_winnow(text, gram, window)}


def test_likeness_equals_a_plain_version(spark):
    rng = random.Random(8)
    rows = [(n, "".join(rng.choice("abcdefgh  é日") for _ in range(rng.randrange(260)))) for n in range(120)]
    rows += [(200, rows[3][1] * 3), (201, rows[3][1] * 2), (202, None), (203, ""), (204, "x"), (205, "x" * 300)]
    found = {r.doc_id: r for r in winnowing.fingerprints_with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for at, (i, text) in enumerate(rows):
        text, following = text or "", rows[(at + 1) % len(rows)][1] or ""
        quarter = len(text) // 4
        own, other, nxt = map(_plain_hashes, (text, text[: len(text) - quarter] + following[:quarter], following))
        for value, side in ((found[i].near_edited, other), (found[i].near_next, nxt)):
            assert value == pytest.approx(len(own & side) / len(own | side) if own | side else 1.0)


def test_three_quarters_of_any_text_are_found():
    rng = random.Random(9)
    for length in [*range(1, 260), 1000]:
        text, other = ("".join(rng.choice(letters) for _ in range(length)) for letters in ("abcdefgh", "ijklmnop"))
        changed = text[: length - length // 4] + other[: length // 4]
        found = [winnowing.winnow(t, *winnowing.scaled(length))[1] for t in (text, changed, other)]
        assert winnowing.likeness(found[0], found[1]) > 0 and winnowing.likeness(found[0], found[2]) == 0


@pytest.mark.parametrize("around", [0, 1, 40, 130])
def test_the_guarantee_holds_between_short_and_long_texts(around):
    rng = random.Random(around)
    for _ in range(60):
        shared = "".join(rng.choice("abcd ") for _ in range(winnowing.GRAM + winnowing.WINDOW - 1))
        short = "e" * around + shared
        long = "".join(rng.choice("efgh") for _ in range(900)) + shared + "h" * 50
        found = [set(winnowing.winnow(t, *winnowing.scaled(len(t)))[1].tolist()) for t in (short, long)]
        assert found[0] & found[1]


# tokens --------------------------------------------------------------------------------------


def test_token_counts(docs):
    found = token_counts.token_counts(docs, WORDS, limit=100, block_chars=50).collect()
    expected = Counter((i, len((t or "").encode()), n := len(_library(WORDS, t)), n > 100) for i, t, _, _ in ROWS)
    assert Counter(map(tuple, found)) == expected


def test_word_pattern_on_every_plain_character():
    pieces = tokens.WordPieces(WORDS)
    texts = [f"X{c}1 {c}{c}  {c}\n{c} a'S{c}'ll{c}_" for c in map(chr, range(0x400))]
    counted = [sum(map(pieces.count, pieces.pretokens(t))) for t in texts]
    assert counted == [len(e.ids) for e in pieces.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_byte_ids_on_many_characters():
    ours = tokens.ByteTokens(BYTES)
    texts = [f"x{c}1 {c}{c}  {c}\n{c} a" for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000, 37)])]
    texts += [t or "" for _, t, _, _ in ROWS]
    library = Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)
    assert [ours.ids(t).tolist() for t in texts] == [e.ids for e in library]


# packing --------------------------------------------------------------------------------------


def test_packed_documents(docs):
    found = packing.packed_documents(docs, BYTES, 64).collect()
    expected = Counter()
    for i, text, _, _ in ROWS:
        ids, at = [*_library(BYTES, text), 0], 0
        sizes = [len(ids) % 64 or 64, *[64] * (len(ids) // 64)] if len(ids) > 64 else [len(ids)]
        for piece, size in enumerate(sizes):
            part = np.array(ids[at : at + size], "<u4")
            if len(part):
                expected[i, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
            at += size
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= -(-sum(r.length for r in found) // 64) + 1


def test_repeated_rows_are_dealt_to_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 8)
    items = spark.range(64).select(F.lit(1).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(30).cast("long").alias("length"))
    found = packing.pack(items, 64).collect()
    assert found[0].asDict().keys() == {"doc_id", "piece", "length", "sequence_id", "offset"}
    assert len(found) == 64 and len({r.sequence_id >> 32 for r in found}) > 1
    assert len({(r.sequence_id, r.offset) for r in found}) == 64 and {r.offset for r in found} == {0, 30}


def test_best_fit_takes_the_tightest_open_bin():
    rng = random.Random(5)
    sizes = sorted((rng.randint(1, 50) for _ in range(400)), reverse=True)
    bins, offsets = packing.best_fit(np.array(sizes), 50)
    rooms, plain = [], []
    for size in sizes:
        fitting = [r for r in rooms if r >= size]
        if fitting:
            at = rooms.index(min(fitting))
        else:
            rooms.append(50)
            at = len(rooms) - 1
        plain.append(50 - rooms[at])
        rooms[at] -= size
    assert len(set(bins.tolist())) == len(rooms) and sorted(offsets.tolist()) == sorted(plain)


# simhash --------------------------------------------------------------------------------------


def _plain_simhash(text):
    terms = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(terms[i : i + 4]) for i in range(max(1, len(terms) - 3))] if terms else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(docs):
    for block in (2048, 1):
        found = simhash.near_duplicates(docs, block=block).collect()
        prints = [(i, _plain_simhash(t)) for i, t, _, _ in ROWS]
        assert Counter((r.doc_id, r.fp[0] % 2**64) for r in found) == Counter(prints)
        least = list(range(len(prints)))
        for _ in prints:
            for a, (_, x) in enumerate(prints):
                for b, (_, y) in enumerate(prints):
                    if (x ^ y).bit_count() <= 4:
                        least[a] = min(least[a], least[b])
        expected = Counter()
        for a, (i, _) in enumerate(prints):
            ids = [prints[b][0] for b in range(len(prints)) if least[b] == least[a] and prints[b][0] is not None]
            expected[i, min(ids, default=None)] += 1
        assert Counter((r.doc_id, r.component_id) for r in found) == expected


@pytest.mark.parametrize("width,radius", [(1, 0), (1, 4), (1, 7), (4, 42), (8, 86)])
def test_bit_planes_count_differing_bits(width, radius):
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, (150, width), dtype=np.uint64)
    for row in range(75, 150):  # near copies of the first half
        fps[row] = fps[row - 75]
        for bit in rng.choice(64 * width, rng.integers(0, 2 * radius + 2), replace=False):
            fps[row, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    child, root = simhash.links(np.zeros(150, np.int64), fps, radius)
    near = [[sum(int(a ^ b).bit_count() for a, b in zip(x, y)) <= radius for y in fps] for x in fps]
    label = list(range(150))
    for _ in range(5):
        for a in range(150):
            label[a] = min(label[b] for b in range(150) if near[a][b])
    ours = np.arange(150)
    ours[child] = root
    assert ours.tolist() == label


def test_similar_texts_meet(spark):
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(400)]
    near = [*base[:200], "new", *base[201:]]
    other = [f"v{rng.randint(0, 9999)}" for _ in range(400)]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(other))]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=5, similarity=0.8, width=4)
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 3}


def test_similarity_decides(spark):
    """Pairs of exact similarity 0.86 link, pairs of 0.57 do not."""
    rng, rows, far = random.Random(6), [], {}
    for n in range(40):
        base = [f"u{n}x{rng.randint(0, 10**9)}" for _ in range(304)]
        edited = list(base)
        for at in range(0, 300, 300 // (11 if n % 2 else 4)):
            edited[at + 4] += "e"
        shingles = [{tuple(t[i : i + 5]) for i in range(300)} for t in (base, edited)]
        similarity = len(shingles[0] & shingles[1]) / len(shingles[0] | shingles[1])
        assert similarity < 0.7 if n % 2 else similarity > 0.83
        far[2 * n + 1] = bool(n % 2)
        rows += [(2 * n, " ".join(base)), (2 * n + 1, " ".join(edited))]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=5, similarity=0.8, width=4)
    of = {r.doc_id: r.component_id for r in found.collect()}
    assert of == {i: i if i % 2 == 0 or far[i] else i - 1 for i in of}


def _with_shared(rng, n, shared):
    """Two texts with `shared` of n shingles of five words each in common: runs of words, others in between."""
    words = lambda k: [f"q{rng.randint(0, 10**12)}" for _ in range(k)]
    head = words(shared + 4)
    return [" ".join(head + words(n - shared)) for _ in range(2)]


def test_exact_similarity_decides_at_the_limit(spark):
    """Pairs of 0.78 stay apart, pairs of 0.80 and 0.82 link; small sets and repeated shingles too."""
    rng, rows, linked = random.Random(8), [], {}
    sizes = [(445, 390), (450, 400), (455, 410)]  # 390 / 500, 400 / 500, 410 / 500
    for k, (n, shared) in enumerate(sizes * 40):
        pair = _with_shared(rng, n, shared)
        rows += [(2 * k, pair[0]), (2 * k + 1, pair[1])]
        linked[2 * k + 1] = shared >= 400
    low = 2 * len(linked)
    for k in range(low, low + 80, 2):  # 4 of 5 shingles
        text = " ".join(f"s{rng.randint(0, 10**12)}" for _ in range(9))
        rows += [(k, text), (k + 1, text.rsplit(" ", 1)[0])]
        linked[k + 1] = True
    line = "one line that comes again and again "
    rows += [(900, "a start " + line * 3), (901, "a start " + line * 300), (902, line * 99 + _with_shared(rng, 90, 9)[0])]
    linked[901], linked[902] = True, False
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=5, similarity=0.8, width=4)
    of = {r.doc_id: r.component_id for r in found.collect()}
    wanted = {i: (900 if i == 901 else i - 1) if linked.get(i) else i for i, _ in rows}
    assert of == wanted


def test_family_of_shared_boilerplate_stays(spark):
    """300 texts of pairwise similarity 0.6, none of which is a near copy."""
    rng = random.Random(9)
    head = " ".join(f"h{rng.randint(0, 10**12)}" for _ in range(154))
    rows = [(i, head + " " + " ".join(f"f{rng.randint(0, 10**12)}" for _ in range(50))) for i in range(300)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=5, similarity=0.8, width=4)
    assert all(r.doc_id == r.component_id for r in found.collect())


# suffix dedup ---------------------------------------------------------------------------------


def _plain_dedup(rows, length=100):
    seen, out = set(), {}
    distinct = {(-1 if i is None else i, (t or "").encode()) for i, t in rows}
    for i, text in sorted(distinct, key=lambda row: (row[0], xxhash.xxh64_intdigest(row[1], seed=42) % 2**32, row[1])):
        gone = bytearray(len(text))
        for p in range(len(text) - length + 1):
            if text[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(text[p : p + length])
        kept = bytes(c for c, g in zip(text, gone) if not g)
        runs = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        out[i, text] = len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()
    return out


@pytest.mark.parametrize("hot", [2048, 1])
def test_repeated_strings_go(docs, hot):
    found = suffix_dedup.deduplicated(docs, hot=hot, chunk=3, block_bytes=1 << 10)
    expected = _plain_dedup([(i, t) for i, t, _, _ in ROWS])
    rows = found.collect()
    assert len(rows) == len(ROWS) and found.columns == [*(c for c in docs.columns if c not in ("_block", "kept_text")), *suffix_dedup.RESULTS]
    for r in rows:
        key = -1 if r.doc_id is None else r.doc_id, (r.text or "").encode()
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[key]
    assert any(n for _, n, _, _ in expected.values())


@pytest.mark.parametrize("hot", [2048, 1])
def test_rows_of_one_id_lie_in_many_blocks(spark, hot):
    rng = random.Random(21)
    passages = ["".join(rng.choice("abcdefg ") for _ in range(rng.randrange(100, 260))) for _ in range(12)]

    def text():
        own = ["".join(rng.choice("hijklmn ") for _ in range(rng.randrange(150))) for _ in range(3)]
        return rng.choice(passages).join(own) if rng.random() < 0.8 else "".join(own)

    rows = [(7, text()) for _ in range(250)] + [(None, text()) for _ in range(60)] + [(i, text()) for i in range(60)]
    rows += rows[:20]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.deduplicated(docs, hot=hot, block_bytes=1 << 11).collect()
    expected = _plain_dedup(rows)
    assert len(found) == len(rows) and sum(n for _, n, _, _ in expected.values()) > 10_000
    for r in found:
        key = -1 if r.doc_id is None else r.doc_id, r.text.encode()
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[key]
    order = F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF))
    assert {(r.text, r.o) for r in docs.select("text", order.alias("o")).collect()} == {(t, suffix_dedup.text_order(t.encode())) for _, t in rows}


@pytest.mark.parametrize("bits", [64, 4, 0])
def test_chance_agreements_of_hashes_are_told_apart(monkeypatch, bits):
    rng = random.Random(7)
    texts = [bytes(rng.choice(b"xyz") for _ in range(40)) for _ in range(6)]
    entries, groups = [], []
    for block in range(9):
        text = texts[block % 6] if block != 8 else texts[2][:25] + b"?" * 15
        one = suffix_dedup.Entry(text[12:24], text[2:12], 2, 0, block, 12)
        run = suffix_dedup.Run(suffix_dedup.encode_run([one]), block)
        run.advance()
        entries.append((run, 0, run.suffix))
        groups.append(block % 6 if block != 8 else 2)
    real = suffix_dedup.mixed
    monkeypatch.setattr(suffix_dedup, "mixed", lambda v: real(v) & np.uint64((1 << bits) - 1))
    found = suffix_dedup.repeats(np.array(groups), entries, 12, 2)
    assert [x.tolist() for x in found] == [[6, 7, 8], [2, 2, 2], [10, 10, 10]]


def test_loser_tree_merges_and_knows_prefixes():
    rng = random.Random(4)
    runs, everything = [], []
    for block in range(7):
        words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 12))).encode() for _ in range(block * 9)]
        entries = [suffix_dedup.Entry(w, b"", 0, 0, 0, i) for i, w in enumerate(words)]
        runs.append(suffix_dedup.Run(suffix_dedup.encode_run(entries), block))
        everything += words
    out, before = [], b""
    for shared, run, _ in suffix_dedup.merged(runs):
        assert shared == suffix_dedup._common(before, run.suffix, 0)
        before = run.suffix
        out.append(before)
    assert out == sorted(everything)


# shards ---------------------------------------------------------------------------------------


def test_curve_visits_neighbours(spark):
    for n, bits in ((2, 3), (3, 2)):
        size = 2**bits
        cells = spark.range(size**n).select(*[(F.floor(F.col("id") / size**i) % size).alias(f"x{i}") for i in range(n)])
        found = cells.withColumn("c", hilbert.curve_index([F.col(f"x{i}") for i in range(n)], bits)).orderBy("c").collect()
        assert [r.c for r in found] == list(range(size**n))
        assert all(sum(abs(a[i] - b[i]) for i in range(n)) == 1 for a, b in zip(found, found[1:]))


def test_shards(docs):
    rows = docs.select("doc_id", "source", "lang", "n_chars")
    found = hilbert.hilbert_shards(rows, ["source", "lang", "n_chars"], shards=4).collect()
    assert Counter((r.doc_id, r.source, r.n_chars) for r in found) == Counter((i, s, len(t or "")) for i, t, _, s in ROWS)
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert sorted((r.shard, r.slot) for r in found) == [(s, i) for s in sorted(sizes) for i in range(sizes[s])]
    order = [r.curve for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


# mixing ---------------------------------------------------------------------------------------


def _water(sizes, weights, share):
    """Targets by giving out what is left, again and again."""
    target = {s: 0.0 for s in sizes}
    left = share * sum(sizes.values())
    while left > 1e-9:
        free = [s for s in sizes if target[s] < 2 * sizes[s] - 1e-9]
        if not free:
            break
        total = sum(weights[s] for s in free)
        more = {s: min(left * weights[s] / total, 2 * sizes[s] - target[s]) for s in free}
        for s in free:
            target[s] += more[s]
        left -= sum(more.values())
    return target


def test_mix(docs):
    found = mixing.mix(docs).collect()
    assert len(found) == len(ROWS)
    sizes = Counter()
    for _, text, _, source in ROWS:
        sizes[source] += len((text or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s))
    expected = _water(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5)
    taken = Counter()
    for r in found:
        assert r.target == pytest.approx(expected[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= 0.5 for s in sizes)
    assert sorted(map(repr, mixing.mix(docs.repartition(2)).collect())) == sorted(map(repr, found))


def test_whole_epochs_come_first(spark):
    rows = [(i, "x", "a b c") for i in range(100)] + [(i, "y", "a") for i in range(100, 130)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    for source in "xy":
        own = [r for r in found if r.source == source]
        whole = int(own[0].target // own[0].source_size)
        assert all(whole * r.size <= r.taken <= (whole + 1) * r.size for r in own)


def test_heavier_documents_come_earlier(spark):
    rows = spark.range(20_000).select(mixing.sampling_key(F.col("id"), F.when(F.col("id") % 2 == 0, 4.0).otherwise(1.0)).alias("v"), "id")
    first = rows.orderBy("v").limit(2_000).filter("id % 2 = 0").count()
    assert first > 1_450


def _plain_taken(rows, keys):
    """Words taken by key from (source, size) rows: whole epochs, then by ascending key until the budget ends."""
    sizes = Counter()
    for source, size in rows:
        sizes[source] += size
    order = sorted(sizes, key=lambda s: (s is None, s))
    targets = _water(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5)
    taken = [0] * len(rows)
    for name, total in sizes.items():
        whole = int(targets[name] // max(total, 1))
        left = int(targets[name] - whole * total + 0.5)
        for i in sorted((i for i, (s, _) in enumerate(rows) if s == name), key=lambda i: keys[i]):
            part = min(rows[i][1], left)
            left -= part
            taken[i] = whole * rows[i][1] + part
    return taken


def test_taken_equals_a_plain_version(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(400), rng.choice(["a", "b", None]), " ".join("w" * rng.randrange(1, 90) for _ in range(rng.randrange(12)))) for _ in range(900)]
    rows += [(7, "hot", "one two three")] * 700 + [(None, "hot", None)] * 300 + [(None, "hot", "four five")] * 200
    rows += [(i, "floor", "x" * 400) for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    size = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    sized = frame.withColumn("size", F.coalesce(size, F.lit(0)))
    weight = mixing.quality_weight(F.col("text"), F.col("size"))
    keyed = sized.withColumn("v", mixing.sampling_key(F.struct("doc_id", "text"), weight)).collect()
    plain = _plain_taken([(r.source, r.size) for r in keyed], [r.v for r in keyed])
    expected = Counter((r.doc_id, r.source, r.text, t) for r, t in zip(keyed, plain))
    found = mixing.mix(frame, keep=["text"]).collect()
    assert Counter((r.doc_id, r.source, r.text, r.taken) for r in found) == expected
    floor = [r.v for r in keyed if r.source == "floor"]
    assert len({v >> 39 for v in floor}) > 100 and len(set(floor)) == 500


def test_kept_columns_may_have_any_name_but_the_results(spark):
    rows = [(i, "x", "a b c", i, -i, f"p{i}") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string, step long, v long, part string")
    found = mixing.mix(frame, keep=["step", "v", "part"]).collect()
    assert all((r.step, r.v, r.part) == (r.doc_id, -r.doc_id, f"p{r.doc_id}") for r in found) and len(found) == 20
    with pytest.raises(ValueError, match="size"):
        mixing.mix(frame.withColumn("size", F.lit(1)), keep=["size"])


# quality --------------------------------------------------------------------------------------


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    found = quality.judged(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    counts = {(r.quality, r.kept): r.n for r in found.join(labels, "doc_id").groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    good, bad = (sum(n for (q, _), n in counts.items() if q == x) for x in (1, 0))
    assert counts.get((1, True), 0) >= 0.97 * good and counts.get((0, False), 0) >= 0.8 * bad


def test_labellers_with_different_accuracies_are_told_apart():
    rng = random.Random(7)
    patterns = Counter()
    truth = defaultdict(list)
    for _ in range(5000):
        good = rng.random() < 0.8
        votes = "".join(str(int(good) if rng.random() < a else 1 - int(good)) if rng.random() < 0.9 else "2" for a in (0.95, 0.9, 0.6, 0.9))
        patterns[votes] += 1
        truth[votes].append(good)
    found = quality.estimate(patterns)
    right = sum(g == (found[v] >= 0.5) for v, gs in truth.items() for g in gs)
    assert right / 5000 > 0.9 and found["0010"] < 0.5 < found["1101"]


def test_quality_of_awkward_rows(docs):
    found = quality.judged(docs)
    rows = found.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert all(not r.kept for r in rows if not (r.text or "").split())


# all of them ----------------------------------------------------------------------------------


def test_empty_tables(no_docs):
    for found in (
        winnowing.fingerprints_with_edits(no_docs),
        token_counts.token_counts(no_docs, WORDS),
        simhash.near_duplicates(no_docs),
        packing.packed_documents(no_docs, BYTES),
        quality.judged(no_docs),
        hilbert.hilbert_shards(no_docs.select("doc_id", "source", "n_chars"), ["source", "n_chars"]),
        suffix_dedup.deduplicated(no_docs),
        mixing.mix(no_docs),
    ):
        assert found.count() == 0


def test_pipeline_stages(spark, docs, no_docs):
    for rows in (docs, no_docs, spark.read.parquet(f"{FOLDER}/documents.parquet")):
        now, columns = rows, rows.columns
        for name, stage in corpus_pipeline.STAGES:
            path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}-{id(rows)}"
            stage(spark, now, FOLDER).write.parquet(path)
            before, now = now, spark.read.parquet(path)
            if name != "best_fit_packing":
                assert now.columns == columns
            if name == "simhash_near_dedup":
                assert now.count() <= before.count()
    clean = spark.createDataFrame([(20, PASSAGE, "en", "a", len(PASSAGE)), (21, PASSAGE, "en", "a", len(PASSAGE))], "doc_id long, text string, lang string, source string, n_chars int")
    assert [r.doc_id for r in corpus_pipeline.one_of_each_group(spark, clean, FOLDER).collect()] == [20]


def test_pipeline_cuts_the_repeated_passage(spark):
    rows = [(i, f"Start number {i} of many. " + PASSAGE + f"And end {i}.", "en", "a", 9) for i in range(5)]
    found = corpus_pipeline.without_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int"), FOLDER)
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts[0] == rows[0][1] and all(PASSAGE not in texts[i] for i in range(1, 5))
