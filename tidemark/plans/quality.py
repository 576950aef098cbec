"""All quality checks over the tables of a lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.ingest import now_utc
from tidemark.operators.standardize import clean_strings, standardize_types, with_event_id
from tidemark.sources.layout import Lake
from tidemark.sources.tables import read_table, write_table


def quality_results(
    bronze: DataFrame,
    silver: DataFrame,
    gold: dict[str, DataFrame],
    event_types: Sequence[str],
) -> DataFrame:
    # Silver ids are made to be there and unique, so what arrived is checked too.
    arrived = clean_strings(bronze)
    if "event_id" in arrived.columns:
        arrived = arrived.withColumn("no_id", F.col("event_id").isNull())
    return quality.check_lake(
        arrived.transform(standardize_types).transform(with_event_id),
        silver,
        gold["fact_events"],
        gold["dim_customer"],
        gold["dim_product"],
        gold["session_summary"],
        event_types,
    )


def run_quality(spark: SparkSession, lake: Lake, event_types: Sequence[str]) -> None:
    """Append one row per check, with the time of the run, to the results table."""
    gold = {
        name: read_table(spark, lake.gold_table(name))
        for name in ("fact_events", "dim_customer", "dim_product", "session_summary")
    }
    results = quality_results(
        read_table(spark, lake.bronze), read_table(spark, lake.silver), gold, event_types
    )
    checked = results.withColumn("checked_at", F.lit(now_utc()).cast("timestamp"))
    write_table(checked, lake.quality, "append")
