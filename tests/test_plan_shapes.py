"""What the physical plans have to look like at scale."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.queries import bronze_rows, keyed_shop
from tests.conftest import SMALL
from tidemark.operators import models, sessions
from tidemark.operators.changes import in_dates
from tidemark.operators.standardize import clean_strings
from tidemark.plans.quality import quality_results
from tidemark.plans.silver import silver_events
from tidemark.sources.tables import read_table, write_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "silver")
    events = keyed_shop(spark, SMALL).withColumn("ingest_ts", F.lit("2024-02-01").cast("timestamp"))
    write_table(events, path)
    return read_table(spark, path)


def test_dedupe_limits_each_group_before_the_shuffle(spark):
    text = plan(silver_events(bronze_rows(spark, SMALL)))
    assert "WindowGroupLimit" in text and "Partial" in text and "Final" in text


def test_session_index_shuffles_aggregates_only(silver):
    index = sessions.session_index(silver)
    below_first = plan(index).split("Exchange hashpartitioning")[-1]
    assert "partial_min" in below_first
    # Cells by cell and by block, on both sides of the join with the blocks, which are brought together by key.
    assert exchanges(index) == 5


def test_no_window_orders_all_cells_of_a_key(silver):
    specs = re.findall(r"windowspecdefinition\(([^$]*?)specifiedwindowframe", plan(sessions.session_index(silver)))
    assert specs and all("_block" in spec for spec in specs)
    by_cell = [spec for spec in specs if "session_cell" in spec]
    assert by_cell and all(spec.index("_block") < spec.index("session_cell") for spec in by_cell)


def test_most_rows_of_the_index_need_no_event_id(silver):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", plan(sessions.session_index(silver)))
    # Each side of the join of cells with their blocks, which is one side at run time.
    assert len(schemas) == 4
    assert sum("event_id" in s for s in schemas) == 2


def test_events_join_the_index_on_user_and_cell(silver):
    index = sessions.session_index(silver)
    facts = models.fact_events(sessions.attach_sessions(models.with_revenue(silver), index, 1800))
    joins = re.findall(r"Join \[([^\]]*)\]", plan(facts))
    assert joins and all("key_number" in keys and ("session_cell" in keys or "_block" in keys) for keys in joins)


def test_events_that_stand_alone_are_not_moved(silver):
    index = sessions.session_index(silver)
    found = sessions.attach_sessions(silver, index, 1800)
    assert re.search(r"PushedFilters: \[[^\]]*(?<!Or\()IsNull\(user_id\)", plan(found))
    branches = plan(sessions.alone_summary(silver))
    assert "Exchange" not in branches and "IsNull(user_id)" in branches


def test_quality_checks_scan_each_table_once(spark, silver):
    text = plan(
        quality_results(
            bronze_rows(spark, SMALL),
            silver,
            {
                "fact_events": silver.withColumnRenamed("user_id", "customer_id"),
                "dim_customer": models.dim_customer(silver),
                "dim_product": models.dim_product(silver),
                "session_summary": sessions.alone_summary(silver),
            },
            ["view"],
        )
    )
    # Bronze, of two source tables in two drops, then silver, facts, two dimensions and sessions.
    scans = len(re.findall("FileScan", text)) - len(re.findall("FileScan", plan(bronze_rows(spark, SMALL))))
    assert scans == 5


def test_dimensions_read_only_their_columns(silver):
    customer = plan(models.dim_customer(silver))
    assert re.search(r"ReadSchema: struct<event_ts:timestamp,user_id:bigint>", customer)
    assert "IsNotNull(user_id)" in customer
    assert "SortAggregate" not in customer
    product = plan(models.dim_product(silver))
    assert "event_id" not in product
    # The pass over all rows hashes; only the few label pairs per product are sorted.
    assert "HashAggregate" in product.split("Exchange hashpartitioning")[-1]
    assert "SortAggregate" not in product.split("Exchange hashpartitioning")[-1]


def test_touched_dates_prune_partitions(silver):
    text = plan(silver.filter(in_dates([date(2024, 1, 3), None])))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", text)


def test_cleaning_is_one_projection(spark):
    assert plan(clean_strings(bronze_rows(spark, SMALL).select("brand", "price"))).count("Sort") == 0


def test_no_python_and_no_cross_join(spark, silver):
    for df in (
        silver_events(bronze_rows(spark, SMALL)),
        sessions.with_session_id(silver),
        models.dim_product(silver),
    ):
        text = plan(df)
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_a_hot_cell_is_split_at_run_time(spark, tmp_path):
    """A third of all rows fall into one user's one cell: adaptive execution splits that join."""
    path = str(tmp_path / "events")
    df = spark.range(300_000, numPartitions=6).select(
        F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("user_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 1000).alias("event_ts"),
        F.lit("view").alias("event_type"),
    )
    df.write.parquet(path)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500KB",
    }
    kept = {k: spark.conf.get(k) for k in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        out = sessions.with_session_id(read_table(spark, path))
        out.write.format("noop").mode("overwrite").save()
        rows = out.collect()
        assert "skew=true" in plan(out)
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert len(rows) == 300_000
    assert len({r.session_id for r in rows if r.user_id == 7}) == 1
