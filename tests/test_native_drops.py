"""The raw files of the native queries are written by many tasks, and still decide nothing between copies."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from checks import queries
from checks.sample_events import native_clicks
from tests.test_jobs import rows_of
from tidemark.operators.ingest import stamp_ingestion
from tidemark.plans import silver_events
from tidemark.sources.raw import read_raw_events

START = datetime(2024, 1, 1)


@pytest.fixture
def tables(spark, tmp_path):
    # Numbers repeat, times and users are missing, and blank native ids fall on equal derived ones.
    events = [
        (i % 150, START + timedelta(minutes=i % 7), i % 3 or None, "view", float(i), f'{{"k": {i % 2}}}') for i in range(400)
    ]
    columns = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, columns).write.parquet(f"{tmp_path}/events.parquet")
    parts = spark.createDataFrame([(0, "a", "b")], "p_partkey long, p_type string, p_brand string")
    parts.write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_native_drops_are_many_files_with_one_per_event(spark, tables, tmp_path):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    kept = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        lake = queries._native_lake(spark, tables)
    finally:
        spark.conf.set(name, kept)
    raw = read_raw_events(spark, f"{lake.root}/raw/drop=1")
    given = native_clicks(spark, tables).filter("drop_no = 1").drop("drop_no")
    assert rows_of(raw.fillna("")) == rows_of(given.fillna(""))
    stamped = stamp_ingestion(raw, START)
    assert stamped.select("source_file").distinct().count() > 1
    keyed = queries.keyed_events(stamped).select("event_id", "source_file").distinct()
    assert keyed.count() == keyed.select("event_id").distinct().count()
    one_file = stamp_ingestion(given.selectExpr("*", "'one' AS source_file"), START)
    assert rows_of(silver_events(stamped).drop("source_file")) == rows_of(silver_events(one_file).drop("source_file"))
