"""Bronze: what is added to a raw row when it is ingested."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse_event_time
from tidemark.sources.raw import source_file


def now_utc() -> datetime:
    return datetime.now(timezone.utc)


def stamp_ingestion(raw: DataFrame, ingested_at: datetime | None = None) -> DataFrame:
    """Add ``ingest_ts``, ``source_file``, ``event_ts`` and ``event_date`` to a raw file scan.

    The instant is fixed when the plan is built, so every action on the result sees the same one.
    """
    instant = F.lit(ingested_at or now_utc()).cast("timestamp")
    named = raw if "source_file" in raw.columns else raw.select("*", source_file().alias("source_file"))
    return named.withColumns(
        {"ingest_ts": instant, "event_ts": parse_event_time(F.col("event_time"))}
    ).withColumn("event_date", F.to_date("event_ts"))
