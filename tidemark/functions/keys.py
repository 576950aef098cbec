"""Deterministic keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator, the hash width and the fields an event key is made of, in order.
KEY_SEPARATOR = "||"
KEY_BITS = 256
EVENT_KEY_FIELDS = ("user_id", "event_ts", "event_type", "product_id")

# Marks of a session key that is not a number: followed by the text itself, or standing for none.
TEXT_KEY = "t"
NO_KEY = "n"


def event_key(present: Sequence[str]) -> Column:
    """SHA-256 over the key fields as text; a null or absent field counts as empty text."""
    known = set(present)
    parts = [
        F.coalesce(F.col(name).cast("string"), F.lit("")) if name in known else F.lit("")
        for name in EVENT_KEY_FIELDS
    ]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), KEY_BITS)


def short_event_id(present: Sequence[str]) -> Column:
    """The event id in the form in which rows are moved: null where the key fields give it, else marked text."""
    text = F.col("event_id").cast("string")
    return F.when(text.isNull(), NO_KEY).when(text != event_key(present), F.concat(F.lit(TEXT_KEY), text))


def whole_event_id(present: Sequence[str]) -> Column:
    """The event id from its short form and the key fields."""
    short = F.col("event_id")
    return F.when(short.isNull(), event_key(present)).when(
        short != NO_KEY, F.substr(short, F.lit(len(TEXT_KEY) + 1))
    )


def session_key_columns() -> dict[str, Column]:
    """The session key, the user or else the event id as text, in a form that hashes fast.

    A key that is the text of a 64-bit integer, as every user is, is held as ``key_number`` with an
    empty ``key_text``; any other as marked text with number 0. Two events have equal columns
    exactly if their keys are equal as text, so a native event id "5" still meets user 5. No column
    is null, which keeps joins on them plain.
    """
    user, event = F.col("user_id").cast("bigint"), F.col("event_id").cast("string")
    integer = event.try_cast("bigint")
    number = F.coalesce(user, F.when(integer.cast("string") == event, integer))
    text = F.when(number.isNotNull(), "").when(event.isNull(), NO_KEY).otherwise(
        F.concat(F.lit(TEXT_KEY), event)
    )
    return {
        "key_number": F.coalesce(number, F.lit(0).cast("bigint")),
        "key_text": text,
        "has_user": user.isNotNull(),
    }


def user_key_columns() -> dict[str, Column]:
    """``session_key_columns`` of events that are known to have a user; reads no event id."""
    return {
        "key_number": F.col("user_id").cast("bigint"),
        "key_text": F.lit(""),
        "has_user": F.lit(True),
    }


def session_key() -> Column:
    """The session key as text, from its columns; null if there is neither user nor event id."""
    number, text = F.col("key_number"), F.col("key_text")
    return F.when(text == "", number.cast("string")).when(
        text != NO_KEY, F.substr(text, F.lit(len(TEXT_KEY) + 1))
    )


def session_id(number: Column) -> Column:
    return F.sha2(F.concat_ws(KEY_SEPARATOR, session_key(), number.cast("string")), KEY_BITS)
