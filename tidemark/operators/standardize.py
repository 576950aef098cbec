"""Silver: cleaning, typing, keying and column order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import blank_to_null, event_key, floating_number, whole_number

# Where the event time is looked for, the numeric columns, and the leading columns.
TIME_COLUMNS = ("event_ts", "event_time", "event_timestamp")
NUMERIC_COLUMNS = {
    "price": "double",
    "amount": "double",
    "quantity": "int",
    "user_id": "bigint",
    "product_id": "bigint",
    "category_id": "bigint",
}
LEADING_COLUMNS = (
    "event_id",
    "event_ts",
    "event_date",
    "event_type",
    "user_id",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "ingest_ts",
    "source_file",
)


def _text_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every string column and null the blank ones, in one projection."""
    text = _text_columns(df)
    return df.select(
        *(blank_to_null(F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns)
    )


def _number(name: str, type_name: str, is_text: bool) -> Column:
    if not is_text:
        return F.col(name).try_cast(type_name)
    if type_name == "double":
        return floating_number(F.col(name))
    return whole_number(F.col(name), type_name)


def standardize_types(df: DataFrame) -> DataFrame:
    """Event time, event date and numbers in their declared types; other columns as they are."""
    text = _text_columns(df)
    typed = {
        name: _number(name, type_name, name in text)
        for name, type_name in NUMERIC_COLUMNS.items()
        if name in df.columns
    }
    time_source = next((c for c in TIME_COLUMNS if c in df.columns), None)
    if time_source:
        typed["event_ts"] = F.col(time_source).try_cast("timestamp")
    if "event_date" in df.columns:
        typed["event_date"] = F.col("event_date").try_cast("date")
    elif time_source:
        typed["event_date"] = F.to_date(typed["event_ts"])
    return df.withColumns(typed)


def with_event_id(df: DataFrame) -> DataFrame:
    """Keep a native ``event_id``; where there is none, derive one from the key fields.

    The id has the type of the native column if that is text, as raw columns are.
    """
    derived = event_key(df.columns)
    if "event_id" in df.columns:
        derived = F.coalesce(F.col("event_id").cast("string"), derived)
    return df.withColumn("event_id", derived)


def stable_order(df: DataFrame) -> DataFrame:
    """Known columns first in their fixed order, then all others as they come."""
    leading = [c for c in LEADING_COLUMNS if c in df.columns]
    return df.select(*leading, *(c for c in df.columns if c not in leading))
