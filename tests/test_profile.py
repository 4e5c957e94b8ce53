from chatlake.operators import profile
from tests import data


def test_basic_counts(spark):
    counts = {r.label: r.n for r in profile.basic_counts(data.source(spark)).collect()}
    assert counts == {"Total messages": 7, "Total conversations": 2, "Total contacts": 2,
                      "Messages with attachments": 2, "Empty messages": 4}


def test_service_keeps_null_and_empty_apart(spark):
    messages = [data.message(1, "a", service=None), data.message(2, "b", service=""),
                data.message(3, "c", service="A"), data.message(4, "d", service="A")]
    rows = profile.count_by_service(data.source(spark, messages)).collect()
    assert sorted(map(tuple, rows)) == [("A", 2), ("Unknown", 1), ("Unknown", 1)]


def test_time_reports_ignore_dates_of_zero(spark):
    hour = 3600 * 10**9
    messages = [data.message(n, "x", date=d) for n, d in
                enumerate([0, None, -5, hour, 25 * hour, 24 * hour * 40])]
    source = data.source(spark, messages)
    assert tuple(profile.time_range(source).first()) == ("2001-01-01 01:00:00",
                                                         "2001-02-10 00:00:00")
    assert [tuple(r) for r in profile.messages_by_month(source).collect()] == [
        ("2001-01", 2), ("2001-02", 1)]
    assert [tuple(r) for r in profile.messages_by_hour(source).collect()] == [("00", 1), ("01", 2)]


def test_length_stats(spark):
    messages = [data.message(n, t) for n, t in enumerate(["😀", "abc", "", None])]
    assert tuple(profile.length_stats(data.source(spark, messages)).first()) == (2.0, 1, 3, 2)


def test_histogram(spark):
    def bins(lengths):
        messages = [data.message(n, "x" * size) for n, size in enumerate(lengths)]
        rows = profile.length_histogram(data.source(spark, messages)).collect()
        assert [r.bin for r in rows] == list(range(30))
        return [r.n for r in rows]

    assert bins([5, 5, 5]) == [3] + [0] * 29
    spread = bins([1, 31, 16, 1000])
    assert (spread[0], spread[15], spread[29]) == (1, 1, 1) and sum(spread) == 3
    assert bins([]) == [0] * 30


def test_top_senders_merge_equal_labels(spark):
    messages = [data.message(1, "a", own=1), data.message(2, "b", handle=1),
                data.message(3, "c", handle=2), data.message(4, "d", handle=9),
                data.message(5, "e", handle=None, own=None)]
    source = data.source(spark, messages, handles=[(1, "same"), (2, "same")])
    assert [tuple(r) for r in profile.top_senders(source).collect()] == [
        ("Unknown", 2), ("same", 2), ("Me", 1)]


def test_conversation_reports(spark):
    source = data.source(spark, chats=[(1, None, ""), (2, None, "B")])
    assert [tuple(r) for r in profile.top_conversations(source).collect()] == [
        (2, "B", 4), (1, "Unnamed Chat", 3)]
    assert tuple(profile.oldest_conversation(source).first()) == (
        1, "Unnamed Chat", "2021-03-04 05:06:07", 3)


def test_recent_messages(spark):
    messages = [data.message(n, "y" * n, date=n * 10**9, own=n % 2) for n in range(46, 53)]
    rows = profile.recent_messages(data.source(spark, messages)).orderBy("message_id").collect()
    assert [r.message_id for r in rows] == [48, 49, 50, 51, 52]
    assert [r.sender for r in rows] == [data.PHONE_A, "Me"] * 2 + [data.PHONE_A]
    assert rows[1].text_sample == "y" * 49 and rows[4].text_sample == "y" * 50 + "..."


def test_all_reports_from_facts_equal_the_single_ones(spark):
    hour = 3600 * 10**9
    texts = ["a" * 5, "b" * 999, "c" * 1000, "", None, "😀", "a" * 5]
    dates = [0, None, -5, hour, 25 * hour, 24 * hour * 40, hour]
    services = [None, "", "A", "A", None, "B", ""]
    messages = [data.message(n, t, date=d, service=s, own=n % 2, handle=n % 4 or None, media=n % 3)
                for n, (t, d, s) in enumerate(zip(texts, dates, services))]
    for rows in (messages, []):
        source = data.source(spark, rows, [(1, n) for n in range(4)] + [(2, 4), (5, 5)])
        found = profile.reports(source, profile.message_facts(source), profile.link_facts(source))
        assert len(found) == 9
        for name, frame in found.items():
            single = getattr(profile, name)(source)
            assert frame.columns == single.columns
            assert sorted(map(str, frame.collect())) == sorted(map(str, single.collect())), name
