import random

import pytest
from pyspark.sql import functions as F

from chatlake.functions import text as tx
from chatlake.functions.clock import clock_text, hour_text, month_text, source_timestamp
from chatlake.operators.clean import keep_clean


def apply(spark, function, values, kind="string"):
    rows = [(number, value) for number, value in enumerate(values)]
    frame = spark.createDataFrame(rows, f"n int, v {kind}")
    found = frame.select("n", function(F.col("v")).alias("r")).orderBy("n").collect()
    return [row["r"] for row in found]


def test_clean_text_cases(spark):
    cases = {
        "Hello": "Hello",
        "Liked a message": "",
        "Likedish": "",
        "liked it": "liked it",
        "emphasized a message": "",
        "They EMPHASIZED it": "",
        "x Reacted With y": "",
        "Hello\ufffc": "Hello",
        "": "",
        None: "",
        " Liked it": "Liked it",
        "\ufffcLiked it": "Liked it",
        "\xa0hi\u3000": "hi",
        " \ufffc \t\ufffc": "",
        "a\nLiked b": "a\nLiked b",
        "emphasİzed": "emphasİzed",
        "a \ufffc b": "a  b",
        "\u200bx\u200b": "\u200bx\u200b",
    }
    assert apply(spark, tx.clean_text, cases) == list(cases.values())


def test_clean_text_strips_every_white_space(spark):
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert len(blanks) == 29
    texts = [f"{blank}a{blank}b{blank}" for blank in blanks] + ["".join(blanks)]
    assert apply(spark, tx.clean_text, texts) == [text.strip() for text in texts]


def test_clean_text_properties(spark):
    """No placeholder and no outer white space is left, and inner text is kept."""
    rng = random.Random(7)
    pieces = ["Liked", "Questioned", "emphasized", "Reacted with", "\ufffc", " ", "\n", "\xa0", "hello", "😀", "Ké"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 5))) for _ in range(400)]
    once = apply(spark, tx.clean_text, texts)
    assert all("\ufffc" not in text and text == text.strip() for text in once)
    assert all(not text or text in before.replace("\ufffc", "") for text, before in zip(once, texts))
    assert 50 < sum(map(bool, once)) < 350


# What stands between the marker's opening quote, eleven places behind its start, and the next quote.
BODIES = {
    b'head\x01\x02NSString$V"see you at nine"tail': "see you at nine",
    b"no marker": None,
    None: None,
    b"": None,
    b'xNSString$V""': None,
    b'xNSString$V"" and NSString$V"later"': None,
    b'xNSString$V"first" and NSString$V"later"': "first",
    b'xNSString$V"open': None,
    b'abcNSStringxx"yy"zz': "gxx",
    b'NSStringxxx"y"': "x",
    b"NSStringxxxxxxxxx": None,
    b'\xe2\x82NSString$V"ab"': "ab",
    b'\xff\xfeNSString$V"\xf0\x9f\x98\x80"': "😀",
    'NSString$V"é😀\nü"'.encode(): "é😀\nü",
    b'"NSString$V"a"': "a",
}


def test_decode_body_cases(spark):
    assert apply(spark, tx.decode_body, BODIES, "binary") == list(BODIES.values())


def test_decode_body_properties(spark):
    """A text without quotes comes back from between any bytes that hold no marker."""
    rng = random.Random(11)
    around = [b"abc", b"\xff", "é".encode(), b"\n", b"NSStr"]
    texts = ["".join(rng.choices("ab é😀\n$V", k=rng.randint(1, 9))) for _ in range(300)]
    bodies = [
        b"".join(rng.choices(around, k=3)) + b'NSString$V"' + text.encode() + b'"' + b"".join(rng.choices(around, k=3))
        for text in texts
    ]
    assert apply(spark, tx.decode_body, bodies, "binary") == texts


def test_decode_long_body(spark):
    long = b"x" * 300_000
    bodies = [long + b'NSString$V"' + long + b'"', long + b"NSString" + long, long]
    assert apply(spark, tx.decode_body, bodies, "binary") == ["x" * 300_000, None, None]


@pytest.mark.parametrize("value,digits", [(62.5, 0), (63.5, 0), (0.125, 2), (0.155, 2),
                                          (0.145, 2), (2.675, 2), (1234567.891, 2), (0.0, 2)])
def test_fixed_decimals(spark, value, digits):
    found = apply(spark, lambda v: tx.fixed_decimals(v, digits), [value], "double")
    assert found == [f"{value:.{digits}f}"]


def test_emoji_count(spark):
    texts = ["😀😀", "☀ and ✈", "none", "𝔘"]
    assert apply(spark, tx.emoji_count, texts) == [2, 2, 0, 0]


def test_preview_and_labels(spark):
    assert apply(spark, tx.preview, ["a" * 49, "a" * 50, "😀" * 60]) == [
        "a" * 49, "a" * 50 + "...", "😀" * 50 + "..."]
    assert apply(spark, lambda v: tx.label_or(v, F.lit("Unknown")), ["", None, "A"]) == [
        "Unknown", "Unknown", "A"]
    assert apply(spark, lambda v: tx.room_name(v, F.lit("cached")), ["", None, "A"]) == [
        "cached", "cached", "A"]


def test_roles_of_unknown_direction_differ(spark):
    assert apply(spark, tx.chat_role, [0, 1, None], "int") == ["user", "assistant", "user"]
    assert apply(spark, tx.party_role, [0, 1, None], "int") == ["friend", "self", "self"]
    assert apply(spark, lambda v: tx.party_contact(v, F.lit("x")), [0, 1, None], "int") == [
        "x", "me", "me"]


def test_source_dates(spark):
    dates = [978307200000000000, 0, -1_500_000_000, 1_999_999_999, None]
    stamp = apply(spark, lambda v: clock_text(source_timestamp(v)), dates, "long")
    assert stamp == ["2032-01-02 00:00:00", "2001-01-01 00:00:00", "2000-12-31 23:59:59",
                     "2001-01-01 00:00:01", None]
    assert apply(spark, lambda v: month_text(source_timestamp(v)), dates[:1], "long") == ["2032-01"]
    assert apply(spark, lambda v: hour_text(source_timestamp(v)), [3600 * 10**9], "long") == ["01"]


def test_dates_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = apply(spark, lambda v: clock_text(source_timestamp(v)), [978307200000000000], "long")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == ["2032-01-02 00:00:00"]


def test_keep_clean_follows_clean_text(spark):
    rng = random.Random(9)
    pieces = ["Loved", "Laughed at", "EMPHASIZED", "reacted with", "\ufffc", " ", "\xa0", "hello", "\u0130"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 4))) for _ in range(300)] + [None]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    found = {r.n: r.text for r in keep_clean(rows).collect()}
    cleaned = apply(spark, tx.clean_text, texts)
    assert found == {n: text for n, text in enumerate(cleaned) if text}


def test_notice_letters_have_no_other_lower_case_source():
    """Spark and Python lower every code point of the phrases alike."""
    letters = set("emphasizedreactedwith")
    odd = [chr(c) for c in range(128, 0x110000) if chr(c).lower() in letters]
    assert odd == []
