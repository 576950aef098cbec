"""Bronze to the silver table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import EVENT_KEY_FIELDS
from tidemark.operators.changes import events_after
from tidemark.operators.dedupe import dedupe_events, latest_per_event
from tidemark.operators.standardize import (
    TIME_COLUMNS,
    clean_strings,
    stable_order,
    standardize_types,
    with_event_id,
)
from tidemark.plans.session import require_utc
from tidemark.sources.tables import DATE_COLUMN, by_date, read_table, write_table


def keyed_events(bronze: DataFrame) -> DataFrame:
    return bronze.transform(typed_events).transform(with_event_id)


def silver_events(bronze: DataFrame) -> DataFrame:
    return bronze.transform(keyed_events).transform(dedupe_events).transform(stable_order)


def derived_key(bronze: DataFrame) -> list[str] | None:
    """The columns that stand for the event id, where every id is derived from them; null if rows may bring an id.

    Once typed they tell events apart just as the id does: numbers and times hold no separator, and no text is empty.
    """
    columns = {*bronze.columns, "event_ts"} if set(TIME_COLUMNS) & set(bronze.columns) else set(bronze.columns)
    if "event_id" in columns or "ingest_ts" not in columns:
        return None
    return [name for name in EVENT_KEY_FIELDS if name in columns]


def typed_events(bronze: DataFrame) -> DataFrame:
    return bronze.transform(clean_strings).transform(standardize_types)


def gathered(rows: DataFrame) -> DataFrame:
    return by_date(rows) if DATE_COLUMN in rows.columns else rows


def silver_rows(bronze: DataFrame) -> DataFrame:
    """``silver_events`` gathered by date, to be written as they are. Derived ids are not moved, but made where the rows are written."""
    key = derived_key(bronze)
    if not key:
        return gathered(silver_events(bronze))
    latest = latest_per_event(typed_events(bronze), key)
    return gathered(latest).transform(with_event_id).transform(stable_order)


def run_silver(
    spark: SparkSession,
    bronze_dir: str,
    silver_dir: str,
    skip_corrupt: bool = False,
    mode: str = "overwrite",
    after: datetime | None = None,
) -> int:
    """Make silver from bronze and return how many rows were written.

    ``append`` adds the rows to those that are there, without looking for copies among them. ``after`` takes
    only events later than an instant, which suits feeds that arrive in order.
    """
    require_utc(spark)
    bronze = events_after(read_table(spark, bronze_dir, skip_corrupt=skip_corrupt), after)
    return write_table(silver_rows(bronze), silver_dir, mode, gather=False)
