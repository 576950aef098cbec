"""Tables keep their columns; no raw file is too old, of another header, or without a date."""

from __future__ import annotations

import os
from datetime import datetime

import pytest

from tests.test_bronze import put
from tests.test_jobs import DAY_ONE, DAY_TWO, HEADER, rows_of
from tidemark.__main__ import main
from tidemark.plans import run_bronze, run_gold, run_incremental, run_quality, run_silver
from tidemark.sources.layout import GOLD_TABLES, Lake
from tidemark.sources.tables import kept_schema, read_table, write_table

PIECES = "2024-01-03 10:00:00 UTC,purchase,1,toys.ball,acme,2.0,1,7"


def test_append_of_other_columns_is_refused_or_widens(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    put(tmp_path / "a", "1.csv", HEADER, *DAY_ONE)
    put(tmp_path / "b", "2.csv", f"{HEADER},quantity", PIECES)
    run_bronze(spark, str(tmp_path / "a"), lake.bronze)
    with pytest.raises(ValueError, match="quantity"):
        run_bronze(spark, str(tmp_path / "b"), lake.bronze)
    assert read_table(spark, lake.bronze).count() == len(DAY_ONE)
    run_bronze(spark, str(tmp_path / "b"), lake.bronze, widen=True)
    assert read_table(spark, lake.bronze).count() == len(DAY_ONE) + 1
    run_silver(spark, lake.bronze, lake.silver)
    run_gold(spark, lake.silver, lake.gold)
    facts = read_table(spark, lake.gold_table("fact_events"))
    assert {r.revenue for r in facts.filter("revenue > 10").collect()} == {14.0}
    # Rows that lack a kept column are fine, and null there.
    put(tmp_path / "c", "3.csv", HEADER, *DAY_TWO)
    run_bronze(spark, str(tmp_path / "c"), lake.bronze)
    assert read_table(spark, lake.bronze).filter("quantity IS NULL").count() == len(DAY_ONE) + len(DAY_TWO)


def test_append_of_other_types_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1,)], "a int"), path)
    with pytest.raises(ValueError, match="types"):
        write_table(spark.createDataFrame([("x",)], "a string"), path, "append", widen=True)
    write_table(spark.createDataFrame([("x",)], "a string"), path)
    assert kept_schema(spark, path).simpleString() == "struct<a:string>"


@pytest.mark.parametrize("bit_by_bit", [False, True])
def test_a_lake_without_any_date(spark, tmp_path, bit_by_bit):
    lake = Lake(str(tmp_path / "lake"))
    put(tmp_path / "raw", "1.csv", HEADER, "rubbish,view,9,,,7,1", "rubbish,purchase,9,,,7,")
    if bit_by_bit:
        run_incremental(spark, str(tmp_path / "raw"), lake)
    else:
        run_bronze(spark, str(tmp_path / "raw"), lake.bronze)
        run_silver(spark, lake.bronze, lake.silver)
        run_gold(spark, lake.silver, lake.gold)
    run_quality(spark, lake, ["view", "purchase"])
    for path in (lake.bronze, lake.silver, lake.gold_table("fact_events")):
        table = read_table(spark, path)
        assert dict(table.dtypes)["event_date"] == "date" and table.count() == 2
    assert read_table(spark, lake.gold_table("session_summary")).count() == 2


def test_old_files_are_ingested(spark, tmp_path):
    raw, lake = tmp_path / "raw", Lake(str(tmp_path / "lake"))
    put(raw, "new.csv", HEADER, *DAY_ONE)
    run_incremental(spark, str(raw), lake)
    put(raw, "old.csv", HEADER, *DAY_TWO)
    month_ago = datetime.now().timestamp() - 30 * 86400
    os.utime(raw / "old.csv", (month_ago, month_ago))
    run_incremental(spark, str(raw), lake, files_per_batch=1)
    assert read_table(spark, lake.bronze).count() == len(DAY_ONE) + len(DAY_TWO)
    assert read_table(spark, lake.gold_table("fact_events")).count() == len(DAY_ONE) + len(DAY_TWO)


def test_blank_native_ids_are_derived_row_by_row(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    rows = [f"2024-01-01 10:0{k}:00 UTC,view,1,toys.ball,acme,5.0,1, " for k in range(5)]
    put(tmp_path / "raw", "1.csv", f"{HEADER},event_id", *rows, "2024-01-01 11:00:00 UTC,view,1,,,5.0,1,7")
    run_incremental(spark, str(tmp_path / "raw"), lake)
    assert read_table(spark, lake.silver).count() == 6
    run_quality(spark, lake, ["view"])
    checks = {(r.check_name, r.layer): r.failed_rows for r in read_table(spark, lake.quality).collect()}
    assert checks["event_id_not_null", "bronze"] == 5
    assert checks["event_id_not_null", "silver"] == 0


def test_header_groups_append_and_after_by_command(spark, tmp_path):
    raw, lake = tmp_path / "raw", Lake(str(tmp_path / "lake"))
    put(raw, "a1.csv", HEADER, *DAY_ONE)
    put(raw, "b1.csv", f"{HEADER},quantity", PIECES)
    main(["bronze", "--raw-dir", str(raw), "--bronze-dir", lake.bronze, "--header-glob", "a*.csv", "b*.csv", "--show", "0"])
    silver = ["silver", "--bronze-dir", lake.bronze, "--silver-dir", lake.silver, "--show", "0"]
    main([*silver, "--after", "2024-01-02"])
    assert [r.quantity for r in read_table(spark, lake.silver).collect()] == [7]
    main([*silver, "--mode", "append"])
    assert read_table(spark, lake.silver).count() == len(DAY_ONE) + 2
    gold = ["gold", "--silver-dir", lake.silver, "--gold-dir", lake.gold, "--show", "0"]
    main(gold)
    once = {name: rows_of(read_table(spark, lake.gold_table(name))) for name in GOLD_TABLES}
    main([*gold, "--mode", "append"])
    for name in GOLD_TABLES:
        assert rows_of(read_table(spark, lake.gold_table(name))) == sorted(once[name] * 2)
