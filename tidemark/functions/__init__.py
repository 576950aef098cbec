"""Column expressions: parsing, keys and measures."""

from tidemark.functions.keys import (
    EVENT_KEY_FIELDS,
    event_key,
    session_id,
    session_key_columns,
    short_event_id,
    user_key_columns,
    whole_event_id,
)
from tidemark.functions.measures import is_purchase, optional, price_band, revenue
from tidemark.functions.parsing import (
    blank_to_null,
    floating_number,
    parse_event_time,
    whole_number,
)

__all__ = [
    "EVENT_KEY_FIELDS",
    "blank_to_null",
    "event_key",
    "floating_number",
    "is_purchase",
    "optional",
    "parse_event_time",
    "price_band",
    "revenue",
    "session_id",
    "session_key_columns",
    "short_event_id",
    "user_key_columns",
    "whole_event_id",
    "whole_number",
]
