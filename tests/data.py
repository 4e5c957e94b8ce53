"""A small source, a small extracted table, and frames made from them."""

from __future__ import annotations

from datetime import datetime, timedelta

from chatlake import schemas
from chatlake.sources.tables import ChatSource

SENT = datetime(2021, 3, 4, 5, 6, 7)
DATE = int((SENT - datetime(2001, 1, 1)).total_seconds()) * 10**9
HEAD = b"\x04\x0bsome archive\x81\xe8\x03\x84\x01"
PHONE_A, PHONE_B = "+15550000001", "+15550000002"


def body(text: str) -> bytes:
    return HEAD + b'NSString$V"' + text.encode() + b'"'


def message(row_id, text, attributed=None, own=0, handle=1, media=0, room="by the gate",
            service="A", emote=0, system=0, date=DATE):
    return (row_id, text, attributed, date, own, handle, media, room, service, emote, system)


MESSAGES = [
    message(11, "See you at nine"),
    message(12, None, body("On my way"), own=1),
    message(15, "Laughed at this", emote=1),
    message(16, None, body("the harbour at dawn"), media=1, handle=2),
    message(18, None, media=1, handle=2),
    message(21, "Who brings the cake?", handle=2),
    message(24, None, body("Ada joined"), handle=2, system=1),
]
CHATS = [(1, "garden", "Neighbours"), (2, "kitchen", "Cooks")]
HANDLES = [(1, PHONE_A), (2, PHONE_B)]
LINKS = [(1, n) for n in (11, 12, 15)] + [(2, n) for n in (16, 18, 21, 24)]


def source(spark, messages=MESSAGES, links=LINKS, chats=CHATS, handles=HANDLES):
    return ChatSource(
        message=spark.createDataFrame(messages, schemas.MESSAGE),
        chat=spark.createDataFrame(chats, schemas.CHAT),
        handle=spark.createDataFrame(handles, schemas.HANDLE),
        link=spark.createDataFrame(links, schemas.LINK),
    )


def extracted_row(message_id, chat_id, text, own=0, contact=PHONE_A, media=0, minute=None):
    at = SENT + timedelta(minutes=message_id if minute is None else minute)
    return (message_id, chat_id, text, at, own, contact, media, SENT, "Neighbours", "garden")


EXTRACTED = [
    extracted_row(31, 5, "Morning, all"),
    extracted_row(33, 5, "Disliked that idea", own=1),
    extracted_row(34, 5, "Tea or coffee?", own=1, media=1),
    extracted_row(35, 5, "Coffee, please"),
    extracted_row(36, 6, None, media=1),
    extracted_row(38, 8, "There is a letter for you"),
    extracted_row(39, 8, "Thanks, I will fetch it", own=1),
]


def extracted(spark, rows=EXTRACTED):
    return spark.createDataFrame(rows, schemas.EXTRACTED)


def cleaned_row(message_id, chat_id, index, text="hi", own=0, media=0):
    return (message_id, chat_id, text, SENT, own, None, media, SENT, f"convo_{chat_id}", index)


def cleaned(spark, rows):
    return spark.createDataFrame(rows, schemas.CLEANED)
