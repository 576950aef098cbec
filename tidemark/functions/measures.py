"""Business measures on one event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: matched anywhere in the lower-cased type, so "reorder" and "border_view" count too.
PURCHASE_PATTERN = "purchase|transaction|order|buy"

# Band label and exclusive upper bound, ascending; labels for no price and the rest.
PRICE_BANDS = (("under_10", 10), ("10_to_50", 50), ("50_to_100", 100))
NO_PRICE = "unknown"
TOP_BAND = "100_plus"


def is_purchase() -> Column:
    """True if the event type names a purchase; a null type is false."""
    return F.coalesce(F.lower(F.col("event_type").cast("string")).rlike(PURCHASE_PATTERN), F.lit(False))


def optional(name: str, present: Sequence[str], type_name: str) -> Column:
    """A column in the given type, null if the rows don't have it."""
    return (F.col(name) if name in present else F.lit(None)).cast(type_name)


def revenue(present: Sequence[str]) -> Column:
    """Price times quantity of a purchase (no price: 0, no quantity: 1), null for other events."""
    price = F.coalesce(optional("price", present, "double"), F.lit(0.0))
    pieces = F.coalesce(optional("quantity", present, "double"), F.lit(1.0))
    return F.when(is_purchase(), price * pieces)


def price_band(price: Column) -> Column:
    """Label of a price; lower bounds are inclusive, and NaN sorts above every bound."""
    band = F.when(price.isNull(), NO_PRICE)
    for label, upper in PRICE_BANDS:
        band = band.when(price < upper, label)
    return band.otherwise(TOP_BAND)
