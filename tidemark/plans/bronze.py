"""Raw files to the bronze table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.operators.ingest import stamp_ingestion
from tidemark.plans.session import require_utc
from tidemark.sources.raw import read_header_groups, read_raw_events
from tidemark.sources.tables import write_table


def run_bronze(
    spark: SparkSession,
    raw_dir: str,
    bronze_dir: str,
    pattern: str = "*.csv",
    mode: str = "append",
    schema: T.StructType | None = None,
    ingested_at: datetime | None = None,
    skip_corrupt: bool = False,
    gather: bool = True,
    header_patterns: Sequence[str] | None = None,
    widen: bool = False,
) -> int:
    """Ingest all matching files and return how many rows were written.

    ``gather=False`` writes without a shuffle; it suits files that are already in time order.
    ``header_patterns`` name one group of files per header, which are read by column name. An append
    of columns that the table lacks is refused unless ``widen`` is set.
    """
    require_utc(spark)
    if header_patterns:
        raw = read_header_groups(spark, raw_dir, header_patterns, skip_corrupt)
    else:
        raw = read_raw_events(spark, raw_dir, pattern, schema, skip_corrupt)
    return write_table(stamp_ingestion(raw, ingested_at), bronze_dir, mode, gather, widen)
