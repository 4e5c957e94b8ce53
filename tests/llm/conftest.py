from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, size string, node string, score string, _block string, kept_text string"

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
PASSAGE = "It was agreed that the committee would meet again on the second Tuesday of each month to hear what had been found. "

#: Nulls, empty and blank texts, ties, repeated rows and ids, special strings, other scripts, a very long text.
ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \n\t ", None, None),
    (4, "one two three", "en", "b"),
    (5, "one two three", "en", "b"),
    (5, "one two three", "en", "b"),
    (5, "another text with the same id", "en", "b"),
    (6, LONG, "en", "a"),
    (7, PASSAGE * 3 + "the end", "en", "c"),
    (8, "before " + PASSAGE + "after", "en", None),
    (9, "<|endoftext|> Grüße, Ünïcödé ²½ ΑΣ İstanbul 日本語 \x1c don't 123 <|startoftext|>!", "de", "c"),
    (10, "a" * 450, "en", "a"),
    (None, "no id here at all", "en", "b"),
    (11, "One Two THREE four five six seven", "en", "a"),
    (12, "one two three FOUR five six seven", "fr", "z"),
    (13, "nul \x00 in!\x00! words \x00\x00 a\x00b", "en", "z"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """`documents` with extra columns that are named like internal ones."""
    rows = [(i, t, g, s, len(t or ""), 7, "x", "y", "z", "b", "k") for i, t, g, s in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
