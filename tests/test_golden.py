"""Known counts of the derived tables at all three sizes."""

import pytest
from pyspark.sql import functions as F

from chatlake.functions import text as tx
from chatlake.operators import conversations as cv
from chatlake.operators import export as ex
from chatlake.operators import pairs, profile, split, style
from chatlake.operators.clean import clean
from chatlake.operators.extract import extract
from chatlake.sources.derived import derived_source

# sf: messages, chats, extracted, with contact, cleaned, pairs, pairs with context
INCREMENTAL = {
    "0.001": (87, 20, 70, 41, 62, 18, 4),
    "0.01": (536, 100, 434, 167, 383, 117, 22),
    "0.1": (5012, 1000, 3992, 1444, 3503, 1045, 170),
}
# sf: conversations of 3 and more, train, validation
SPLIT = {"0.001": (13, 11, 2), "0.01": (77, 69, 8), "0.1": (687, 618, 69)}
# sf: rows in chats with 5 and more, chats, pairs, pairs with context
EXPORT = {"0.001": (28, 5, 10, 4), "0.01": (246, 45, 81, 23), "0.1": (2009, 368, 635, 177)}
# sf: mean length, emojis per message, own messages, over own cleaned messages
STYLE = {
    "0.001": (848.423077, 0.076923, 26),
    "0.01": (975.841176, 0.064706, 170),
    "0.1": (957.945707, 0.069444, 1584),
}
# sf: months, services, non-empty bins
PROFILE = {"0.001": (1, 3, 22), "0.01": (1, 3, 30), "0.1": (3, 3, 30)}


def pair_counts(rows):
    found = pairs.reply_pairs(rows)
    return tuple(found.agg(F.count(F.lit(1)), F.count_if(F.size("context") > 0)).first())


@pytest.mark.parametrize("sf", list(INCREMENTAL))
def test_counts(spark, sf):
    source = derived_source(spark, f"/root/testdata/sf{sf}")
    messages = extract(source)
    cleaned = clean(messages, sizes=source.link)
    by_party = cleaned.withColumn("role", tx.party_role(F.col("is_from_me"))).withColumnRenamed(
        "text", "content"
    )
    assert INCREMENTAL[sf] == (
        source.message.count(),
        source.chat.count(),
        *messages.agg(F.count(F.lit(1)), F.count("contact_id")).first(),
        cleaned.count(),
        *pair_counts(by_party),
    )
    metadata = split.dataset_metadata(cv.conversation_sizes(cleaned)).first()
    assert SPLIT[sf] == tuple(metadata)[1:]
    stats = style.style_stats(by_party).first()
    assert STYLE[sf] == (
        round(stats.mean_length, 6), round(stats.emojis_per_message, 6), stats.own_messages)

    exported = ex.export_messages(source)
    assert EXPORT[sf] == (
        *exported.agg(F.count(F.lit(1)), F.count_distinct("chat_id")).first(),
        *pair_counts(exported),
    )
    assert PROFILE[sf] == (
        profile.messages_by_month(source).count(),
        profile.count_by_service(source).count(),
        profile.length_histogram(source).filter("n > 0").count(),
    )
    assert profile.messages_by_hour(source).count() == 16
