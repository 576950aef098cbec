"""The jobs from raw files to gold, in one go and bit by bit."""

from __future__ import annotations

import os
import shutil
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from checks.queries import EVENT_TYPES
from tests.test_bronze import put
from tidemark.operators.changes import events_after, processed_through
from tidemark.plans import run_bronze, run_gold, run_incremental, run_quality, run_silver
from tidemark.plans.incremental import done_through
from tidemark.sources.export import export_csv
from tidemark.sources.layout import GOLD_TABLES, Lake
from tidemark.sources.scratch import shared_dir
from tidemark.sources.tables import read_table, replace_dates, version_of

HEADER = "event_time,event_type,product_id,category_code,brand,price,user_id"

DAY_ONE = (
    "2024-01-01 10:00:00 UTC,view,1,toys.ball,acme,5.0,1",
    "2024-01-01 10:10:00 UTC, purchase ,1,toys.ball,acme,5.0,1",
    "2024-01-01 23:50:00 UTC,view,2,,zeta,60.0,1",
    "2024-01-01 12:00:00 UTC,view,2,,zeta,61.0,2",
    "2024-01-01 12:00:00 UTC,view,2,,zeta,61.0,",
    "garbage,view,3,,,7,1",
)
DAY_TWO = (
    "2024-01-02 00:10:00 UTC,purchase,2,,zeta,60.0,1",
    "2024-01-02 09:00:00 UTC,view,1,toys.ball,acme,6.0,3",
    "2024-01-02 12:00:00 UTC,view,1,toys.ball,acme,6.0,2",
)
LATE = (
    "2024-01-01 08:00:00 UTC,view,1,toys.ball,acme,5.5,1",
    "2024-01-01 12:00:00 UTC,view,2,,zeta,71.0,2",
)
LATE_UNTIMED = ("rubbish,view,9,,,7,1", "rubbish,view,9,,,7,")


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def rebuilt(spark, lake, folder):
    """Silver and gold made anew from the same bronze."""
    run_silver(spark, lake.bronze, f"{folder}/silver")
    run_gold(spark, f"{folder}/silver", f"{folder}/gold")
    return folder


def assert_like_rebuilt(spark, lake, folder):
    rebuilt(spark, lake, folder)
    assert rows_of(read_table(spark, lake.silver)) == rows_of(read_table(spark, f"{folder}/silver"))
    for name in GOLD_TABLES:
        grown, full = read_table(spark, lake.gold_table(name)), read_table(spark, f"{folder}/gold/{name}")
        assert grown.columns == full.columns
        assert rows_of(grown) == rows_of(full), name


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def test_batch_jobs(spark, tmp_path, lake):
    put(tmp_path / "raw", "1.csv", HEADER, *DAY_ONE, *DAY_TWO, DAY_ONE[0])
    assert run_bronze(spark, str(tmp_path / "raw"), lake.bronze) == 10
    assert run_silver(spark, lake.bronze, lake.silver) == 9
    run_gold(spark, lake.silver, lake.gold)
    summary = read_table(spark, lake.gold_table("session_summary"))
    across_midnight = summary.filter("customer_id = 1 and date(start_ts) <> date(end_ts)").collect()
    assert [(r.event_count, r.purchased_flag) for r in across_midnight] == [(2, True)]
    facts = read_table(spark, lake.gold_table("fact_events"))
    assert facts.count() == 9
    assert facts.agg(F.sum("revenue")).first()[0] == 65.0

    once = {n: rows_of(read_table(spark, lake.gold_table(n))) for n in GOLD_TABLES}
    run_silver(spark, lake.bronze, lake.silver)
    run_gold(spark, lake.silver, lake.gold)
    assert once == {n: rows_of(read_table(spark, lake.gold_table(n))) for n in GOLD_TABLES}

    run_quality(spark, lake, EVENT_TYPES)
    run_quality(spark, lake, EVENT_TYPES)
    results = read_table(spark, lake.quality)
    assert results.groupBy("checked_at").count().select("count").distinct().collect()[0][0] == 10
    failed = {(r.check_name, r.layer) for r in results.filter("not passed").collect()}
    # One raw row came twice, which silver no longer shows.
    assert failed == {("event_ts_not_null", "silver"), ("event_id_unique", "bronze")}

    facts = read_table(spark, lake.gold_table("fact_events"))
    export_csv(facts, f"{lake.root}/export/fact_events")
    back = spark.read.schema(facts.schema).option("header", "true").csv(f"{lake.root}/export/fact_events")
    assert rows_of(back) == rows_of(facts)


def test_incremental_runs_equal_a_rebuild(spark, tmp_path, lake):
    raw = tmp_path / "raw"
    for step, lines in enumerate((DAY_ONE, DAY_TWO, LATE, LATE_UNTIMED)):
        put(raw, f"{step}.csv", HEADER, *lines)
        run_incremental(spark, str(raw), lake)
        assert_like_rebuilt(spark, lake, str(tmp_path / f"full-{step}"))
    assert read_table(spark, lake.bronze).count() == 13

    before = {n: rows_of(read_table(spark, lake.gold_table(n))) for n in GOLD_TABLES}
    run_incremental(spark, str(raw), lake)
    assert read_table(spark, lake.bronze).count() == 13
    assert before == {n: rows_of(read_table(spark, lake.gold_table(n))) for n in GOLD_TABLES}


def test_cells_across_midnight(spark, tmp_path, lake):
    """A gap that does not divide the day makes cells that lie in two dates."""
    raw = tmp_path / "raw"
    times = ("01 23:40:00", "01 23:59:00", "02 00:01:00", "02 00:20:00", "03 00:05:00")
    lines = [f"2024-01-{t} UTC,view,1,,,1,{user}" for t in times for user in (1, 2)]
    put(raw, "1.csv", HEADER, *lines[:4])
    run_incremental(spark, str(raw), lake, session_gap_minutes=77)
    put(raw, "2.csv", HEADER, *lines[4:], "2024-01-01 22:00:00 UTC,view,1,,,1,1")
    run_incremental(spark, str(raw), lake, session_gap_minutes=77)
    run_gold(spark, lake.silver, f"{lake.root}/full", session_gap_minutes=77)
    for name in GOLD_TABLES:
        full = read_table(spark, f"{lake.root}/full/{name}")
        assert rows_of(read_table(spark, lake.gold_table(name))) == rows_of(full)


def test_in_order_files_leave_old_fact_dates_alone(spark, tmp_path, lake):
    raw = tmp_path / "raw"
    put(raw, "1.csv", HEADER, *DAY_ONE[:5])
    run_incremental(spark, str(raw), lake)
    before = version_of(spark, lake.gold_table("fact_events")).parts
    put(raw, "2.csv", HEADER, *DAY_TWO)
    run_incremental(spark, str(raw), lake)
    after = version_of(spark, lake.gold_table("fact_events")).parts
    assert set(before) == {"2024-01-01"} and set(after) == {"2024-01-01", "2024-01-02"}
    assert after["2024-01-01"] == before["2024-01-01"]


def test_native_ids_move_between_dates(spark, tmp_path, lake):
    raw, header = tmp_path / "raw", f"event_id,{HEADER}"
    put(raw, "1.csv", header, *(f"{i},{line}" for i, line in enumerate(DAY_ONE)))
    put(raw, "2.csv", header, f"100,{DAY_TWO[0]}", "200,2024-01-05 10:00:00 UTC,view,1,,,1,9")
    run_incremental(spark, str(raw), lake)
    assert_like_rebuilt(spark, lake, str(tmp_path / "full-0"))
    # Event 200 was the only one of its date; its newer copy lies elsewhere, and event 1 moves too.
    put(
        raw,
        "3.csv",
        header,
        "200,2024-01-03 10:00:00 UTC,view,1,,,1,9",
        "1,2024-01-02 00:15:00 UTC,view,1,,,1,1",
    )
    run_incremental(spark, str(raw), lake)
    assert_like_rebuilt(spark, lake, str(tmp_path / "full-1"))
    dates = {str(r[0]) for r in read_table(spark, lake.silver).select("event_date").distinct().collect()}
    assert "2024-01-05" not in dates


def test_events_after_what_was_processed(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, None)], "x int, event_ts timestamp"
    )
    assert [r.x for r in events_after(df, processed_through(df.filter("x = 1"))).collect()] == [2]
    assert events_after(df, processed_through(df)).isEmpty()
    assert events_after(df, processed_through(df.filter("x = 3"))).count() == 3


@pytest.mark.parametrize("broken", ["refresh_silver", "refresh_gold", "note_done", "fact_rows", "merge_products"])
def test_a_run_that_broke_off_is_made_good_by_the_next(spark, tmp_path, lake, monkeypatch, broken):
    from tidemark.operators import models
    from tidemark.plans import incremental

    raw = tmp_path / "raw"
    put(raw, "1.csv", HEADER, *DAY_ONE)
    run_incremental(spark, str(raw), lake)

    def stop(*_args, **_kwargs):
        raise RuntimeError("lost")

    put(raw, "2.csv", HEADER, *DAY_TWO, *LATE)
    with monkeypatch.context() as patch:
        patch.setattr(models if broken == "merge_products" else incremental, broken, stop)
        with pytest.raises(RuntimeError, match="lost"):
            run_incremental(spark, str(raw), lake)
    put(raw, "3.csv", HEADER, *LATE_UNTIMED)
    run_incremental(spark, str(raw), lake)
    assert_like_rebuilt(spark, lake, str(tmp_path / "full"))


def test_streamed_and_batch_bronze_mix(spark, tmp_path, lake):
    put(tmp_path / "batch", "1.csv", HEADER, *DAY_ONE)
    run_bronze(spark, str(tmp_path / "batch"), lake.bronze)
    raw = tmp_path / "raw"
    put(raw, "2.csv", HEADER, *DAY_TWO)
    run_incremental(spark, str(raw), lake)
    put(tmp_path / "late", "3.csv", HEADER, *LATE)
    run_bronze(spark, str(tmp_path / "late"), lake.bronze)
    run_incremental(spark, str(raw), lake)
    assert read_table(spark, lake.bronze).count() == len(DAY_ONE) + len(DAY_TWO) + len(LATE)
    assert_like_rebuilt(spark, lake, str(tmp_path / "full"))


def test_a_lost_checkpoint_is_refused(spark, tmp_path, lake):
    put(tmp_path / "raw", "1.csv", HEADER, *DAY_ONE)
    run_incremental(spark, str(tmp_path / "raw"), lake)
    shutil.rmtree(lake.ingest_checkpoint)
    with pytest.raises(ValueError, match="checkpoint"):
        run_incremental(spark, str(tmp_path / "raw"), lake)


def test_progress_is_kept_per_layer(spark, tmp_path, lake):
    assert done_through(spark, lake, "silver") is None
    raw = tmp_path / "raw"
    for step, lines in enumerate((DAY_ONE, DAY_TWO), 1):
        put(raw, f"{step}.csv", HEADER, *lines)
        run_incremental(spark, str(raw), lake)
        assert done_through(spark, lake, "silver") == version_of(spark, lake.bronze).number == step
        assert done_through(spark, lake, "gold", 1800) == version_of(spark, lake.silver).number == step
    assert done_through(spark, lake, "gold", 60) is None


def test_another_gap_remakes_gold(spark, tmp_path, lake):
    raw = tmp_path / "raw"
    put(raw, "1.csv", HEADER, *DAY_ONE)
    run_incremental(spark, str(raw), lake)
    put(raw, "2.csv", HEADER, *DAY_TWO)
    run_incremental(spark, str(raw), lake, session_gap_minutes=5)
    run_gold(spark, lake.silver, f"{lake.root}/gap5", session_gap_minutes=5)
    for name in GOLD_TABLES:
        other = read_table(spark, f"{lake.root}/gap5/{name}")
        assert rows_of(read_table(spark, lake.gold_table(name))) == rows_of(other)
    put(raw, "3.csv", HEADER, *LATE)
    run_incremental(spark, str(raw), lake)
    assert_like_rebuilt(spark, lake, str(tmp_path / "full"))


def test_staged_tables_are_removed(spark, tmp_path, lake):
    shared = shared_dir(spark)
    before = set(os.listdir(shared))
    put(tmp_path / "raw", "1.csv", HEADER, *DAY_ONE)
    run_incremental(spark, str(tmp_path / "raw"), lake)
    run_gold(spark, lake.silver, f"{lake.root}/again")
    assert set(os.listdir(shared)) == before


def test_replacing_dates_touches_no_others(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.createDataFrame(
        [(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], "x int, event_date string"
    ).withColumn("event_date", F.col("event_date").cast("date"))
    replace_dates(table, path, [r.event_date for r in table.collect()])
    assert read_table(spark, path).count() == 3
    changed = table.filter("x = 2").withColumn("x", F.lit(20))
    replace_dates(changed, path, [r.event_date for r in table.filter("x >= 2").collect()])
    assert sorted(r.x for r in read_table(spark, path).collect()) == [1, 20]
