"""Text to typed values. A cell that does not parse becomes null and never fails the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layouts tried first, in this order. 'UTC' is a literal, not a zone field.
RAW_TIME_LAYOUTS = ("yyyy-MM-dd HH:mm:ss 'UTC'", "yyyy-MM-dd HH:mm:ss")

# An optional sign and digits, with an optional fraction that is cut off.
WHOLE_NUMBER = r"^\s*([+-]?\d+)(\.\d*)?\s*$"


def parse_event_time(text: Column) -> Column:
    """Timestamp of a raw time cell: each layout in turn, then Spark's own reading, else null."""
    tries = [F.try_to_timestamp(text, F.lit(layout)) for layout in RAW_TIME_LAYOUTS]
    return F.coalesce(*tries, text.try_cast("timestamp"))


def blank_to_null(text: Column) -> Column:
    """Strip spaces (spaces only, tabs stay) and turn an empty rest into null."""
    return F.nullif(F.trim(text), F.lit(""))


def whole_number(text: Column, type_name: str) -> Column:
    """Integer value of a text cell, fraction cut off; null if malformed or out of range.

    Works on the digits, so a 19-digit id is not rounded as it would be by way of a double.
    """
    return F.regexp_extract(text, WHOLE_NUMBER, 1).try_cast(type_name)


def floating_number(text: Column) -> Column:
    return text.try_cast("double")
