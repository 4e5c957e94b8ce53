"""Explicit schemas; nothing is inferred on read."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _schema(**columns):
    return StructType([StructField(name, kind) for name, kind in columns.items()])


MESSAGE = _schema(
    row_id=LongType(),
    text=StringType(),
    attributedBody=BinaryType(),
    date=LongType(),
    is_from_me=IntegerType(),
    handle_id=LongType(),
    cache_has_attachments=IntegerType(),
    cache_roomnames=StringType(),
    service=StringType(),
    is_emote=IntegerType(),
    is_system_message=IntegerType(),
)
# A message whose link names a chat that is not listed yet.
WAITING = StructType([*MESSAGE.fields, StructField("chat_id", LongType())])
CHAT = _schema(row_id=LongType(), room_name=StringType(), display_name=StringType())
HANDLE = _schema(row_id=LongType(), id=StringType())
LINK = _schema(chat_id=LongType(), message_id=LongType())

# `timestamp` is the UTC wall clock without a zone, so its text form does not depend on
# the session time zone.
EXTRACTED = _schema(
    message_id=LongType(),
    chat_id=LongType(),
    text=StringType(),
    timestamp=TimestampNTZType(),
    is_from_me=IntegerType(),
    contact_id=StringType(),
    has_media=IntegerType(),
    processed_at=TimestampType(),
    chat_name=StringType(),
    room_name=StringType(),
)
CLEANED = _schema(
    message_id=LongType(),
    chat_id=LongType(),
    text=StringType(),
    timestamp=TimestampNTZType(),
    is_from_me=IntegerType(),
    contact_id=StringType(),
    has_media=IntegerType(),
    cleaned_at=TimestampType(),
    conversation_id=StringType(),
    message_index=LongType(),
)
CHAT_SIZES = _schema(chat_id=LongType(), message_count=LongType())
PROGRESS = _schema(
    batch_id=LongType(),
    attempt=StringType(),
    last_id=LongType(),
    row_count=LongType(),
    updated_at=TimestampType(),
)

CHAT_MESSAGE = _schema(role=StringType(), content=StringType())
DOCUMENT_MESSAGE = _schema(
    role=StringType(),
    content=StringType(),
    timestamp=StringType(),
    contact_id=StringType(),
    has_media=BooleanType(),
)
# `part` is absent from documents that fit in one row and reads as null there.
DOCUMENT = _schema(
    id=StringType(),
    title=StringType(),
    messages=ArrayType(DOCUMENT_MESSAGE),
    message_count=LongType(),
    part=LongType(),
)
