"""What a small drop costs an old lake: the files it reads and those it writes."""

from __future__ import annotations

import re
import shutil
from pathlib import Path

import pytest

from tests.test_bronze import put
from tests.test_jobs import DAY_ONE, DAY_TWO, HEADER, LATE, assert_like_rebuilt, rows_of
from tests.test_plan_shapes import plan
from tidemark.plans import incremental, run_incremental
from tidemark.sources.files import first_line
from tidemark.sources.layout import GOLD_TABLES, Lake
from tidemark.sources.tables import UNDATED, read_table, version_of
from tidemark.streaming.ingest import set_aside


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def days(first, last, users="12"):
    return [f"2024-01-{d:02} 10:00:00 UTC,view,{d % 3 + 1},a.b,acme,{d}.5,{u}" for d in range(first, last) for u in users]


@pytest.mark.parametrize("native", [False, True])
def test_a_drop_in_order_reads_no_older_bronze_or_silver(spark, tmp_path, lake, native):
    raw, header = tmp_path / "raw", f"event_id,{HEADER}" if native else HEADER
    mark = (lambda k, lines: [f"{k}{i},{line}" for i, line in enumerate(lines)]) if native else (lambda k, lines: lines)
    put(raw, "1.csv", header, *mark("a", days(1, 9)))
    run_incremental(spark, str(raw), lake)
    aside = tmp_path / "aside"
    for path in (lake.bronze, lake.silver, lake.gold_table("fact_events"), lake.gold_table("session_summary")):
        for folder in Path(path).glob("_write=*"):
            shutil.move(folder, aside / str(len(list(aside.glob("*")))) / folder.relative_to(lake.root))
    # The old files are out of reach, so a run that asked for any of them would fail.
    put(raw, "2.csv", header, *mark("b", days(9, 10)))
    run_incremental(spark, str(raw), lake)
    for kept in aside.glob("*"):
        shutil.copytree(kept, lake.root, dirs_exist_ok=True)
    assert_like_rebuilt(spark, lake, str(tmp_path / "full"))


def test_a_late_event_rewrites_its_own_and_renumbered_dates_only(spark, tmp_path, lake):
    raw, summary = tmp_path / "raw", lake.gold_table("session_summary")
    put(raw, "1.csv", HEADER, *days(1, 20, "1"), *days(1, 10, "2"))
    run_incremental(spark, str(raw), lake)
    before = {path: version_of(spark, path).parts for path in (summary, lake.gold_table("fact_events"), lake.silver)}
    put(raw, "2.csv", HEADER, "2024-01-08 15:00:00 UTC,view,1,a.b,acme,1.5,2")
    run_incremental(spark, str(raw), lake)
    for path, parts in before.items():
        now = version_of(spark, path).parts
        changed = {name for name in now if now[name] != parts.get(name)}
        # User 2 had a session on the 8th already; the 9th is renumbered, and nobody else is touched.
        assert changed == ({"2024-01-08"} if path == lake.silver else {"2024-01-08", "2024-01-09"}), path
    assert_like_rebuilt(spark, lake, str(tmp_path / "full"))


def test_new_ids_are_looked_up_without_moving_the_known_ones(spark, tmp_path, lake):
    raw = tmp_path / "raw"
    put(raw, "1.csv", f"event_id,{HEADER}", *(f"{i},{line}" for i, line in enumerate(days(1, 20))))
    run_incremental(spark, str(raw), lake)
    ids = spark.createDataFrame([(str(i),) for i in (3, 5, 1000)], "event_id string").repartition(4)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = incremental.dates_of_ids(spark, lake, ids)
        text = plan(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert sorted(r.part for r in found.collect()) == ["2024-01-02", "2024-01-03"]
    # One exchange, of the new ids, into as many partitions as there are buckets.
    assert re.findall(r"Exchange hashpartitioning\(event_id[^,]*, (\d+)\)", text) == [str(incremental.ID_BUCKETS)]
    assert f"SelectedBucketsCount: {incremental.ID_BUCKETS}" in text


def test_moved_ids_leave_no_trace(spark, tmp_path, lake):
    raw, header = tmp_path / "raw", f"event_id,{HEADER}"
    put(raw, "1.csv", header, "a,2024-01-01 10:00:00 UTC,view,1,,,1,7", "b,2024-01-03 10:00:00 UTC,view,1,,,1,7")
    run_incremental(spark, str(raw), lake)
    for step, day in enumerate(("05", "02", "05"), 2):
        put(raw, f"{step}.csv", header, f"a,2024-01-{day} 10:00:00 UTC,view,1,,,1,{step}", "c,junk,view,1,,,1,7")
        run_incremental(spark, str(raw), lake)
        assert_like_rebuilt(spark, lake, str(tmp_path / f"full-{step}"))
    assert set(version_of(spark, lake.silver).parts) == {"2024-01-03", "2024-01-05", UNDATED}


@pytest.mark.parametrize("broken", ["write_table", "replace_dates", "_note_ids", "append_bucketed", "publish_next"])
def test_native_runs_that_broke_off(spark, tmp_path, lake, monkeypatch, broken):
    raw, header = tmp_path / "raw", f"event_id,{HEADER}"
    put(raw, "1.csv", header, *(f"{i},{line}" for i, line in enumerate(DAY_ONE)))
    run_incremental(spark, str(raw), lake)
    put(raw, "2.csv", header, f"1,{DAY_TWO[0]}", f"9,{DAY_TWO[1]}")
    with monkeypatch.context() as patch:
        patch.setattr(incremental, broken, lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run_incremental(spark, str(raw), lake)
    put(raw, "3.csv", header, f"9,{LATE[0]}", f"0,{LATE[1]}")
    run_incremental(spark, str(raw), lake)
    assert_like_rebuilt(spark, lake, str(tmp_path / "full"))


def test_files_of_other_headers(spark, tmp_path, lake):
    raw = tmp_path / "raw"
    put(raw, "1.csv", HEADER, *DAY_ONE)
    run_incremental(spark, str(raw), lake)
    put(raw, "0.csv", f"{HEADER},quantity", f"{DAY_TWO[0]},3")
    put(raw, "2.csv", "user_id,event_time,event_type,price", "1,2024-01-03 10:00:00 UTC,view,2.5")
    put(raw, "3.csv", "no,events,here", "1,2,3")
    put(raw, "4 [x] {a,b}*.csv", HEADER, DAY_TWO[1])
    put(raw, "5.csv", "")
    run_incremental(spark, str(raw), lake)
    bronze = read_table(spark, lake.bronze)
    assert bronze.count() == len(DAY_ONE) + 2
    assert [r.price for r in bronze.filter("event_date = date '2024-01-03'").collect()] == ["2.5"]
    aside = set_aside(spark, lake.bronze)
    assert {Path(path).name: columns[-1] for path, columns in aside.items()} == {"0.csv": "quantity", "3.csv": "here"}
    assert_like_rebuilt(spark, lake, str(tmp_path / "full-1"))

    run_incremental(spark, str(raw), lake, widen=True)
    assert {Path(path).name for path in set_aside(spark, lake.bronze)} == {"3.csv"}
    assert [r.quantity for r in read_table(spark, lake.silver).filter("quantity IS NOT NULL").collect()] == [3]
    assert_like_rebuilt(spark, lake, str(tmp_path / "full-2"))
    # A file that was mended is taken in by the next run, and one that is gone is forgotten about.
    put(raw, "3.csv", HEADER, DAY_TWO[2])
    run_incremental(spark, str(raw), lake)
    run_incremental(spark, str(raw), lake)
    assert set_aside(spark, lake.bronze) == {}
    assert read_table(spark, lake.bronze).count() == len(DAY_ONE) + 4
    assert_like_rebuilt(spark, lake, str(tmp_path / "full-3"))


def test_a_run_that_only_sets_files_aside_rewrites_nothing(spark, tmp_path, lake):
    raw = tmp_path / "raw"
    put(raw, "1.csv", HEADER, *DAY_ONE)
    run_incremental(spark, str(raw), lake)
    tables = [lake.silver, *(lake.gold_table(name) for name in GOLD_TABLES)]
    before = [version_of(spark, path).parts for path in tables]
    put(raw, "2.csv", f"{HEADER},extra", f"{DAY_TWO[0]},x")
    run_incremental(spark, str(raw), lake)
    assert [version_of(spark, path).parts for path in tables] == before and set_aside(spark, lake.bronze)
    put(raw, "3.csv", HEADER, *DAY_TWO)
    run_incremental(spark, str(raw), lake)
    assert_like_rebuilt(spark, lake, str(tmp_path / "full"))


def test_a_step_that_is_repeated_adds_nothing(spark, tmp_path, lake, monkeypatch):
    """A crash between the publication of a step and the note of it in the checkpoint."""
    raw = tmp_path / "raw"
    put(raw, "1.csv", HEADER, *DAY_ONE)
    run_incremental(spark, str(raw), lake)
    commits = Path(lake.ingest_checkpoint) / "commits"
    for name in ("0", ".0.crc"):
        (commits / name).unlink(missing_ok=True)
    put(raw, "2.csv", HEADER, *DAY_TWO)
    run_incremental(spark, str(raw), lake)
    assert read_table(spark, lake.bronze).count() == len(DAY_ONE) + len(DAY_TWO)
    assert_like_rebuilt(spark, lake, str(tmp_path / "full"))


def test_ids_that_come_later_remake_silver(spark, tmp_path, lake):
    raw = tmp_path / "raw"
    put(raw, "1.csv", HEADER, *DAY_ONE)
    run_incremental(spark, str(raw), lake)
    put(raw, "2.csv", f"event_id,{HEADER}", *(f"{i},{line}" for i, line in enumerate(DAY_TWO)))
    run_incremental(spark, str(raw), lake, widen=True)
    assert_like_rebuilt(spark, lake, str(tmp_path / "full"))
    assert len(rows_of(read_table(spark, lake.silver))) == len(DAY_ONE) + len(DAY_TWO)


def test_first_lines(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv.gz").write_bytes(gzip.compress("é,b\n1,2\n".encode()))
    (tmp_path / "b.csv").write_text("")
    assert first_line(spark, str(tmp_path / "a.csv.gz")) == "é,b"
    assert first_line(spark, str(tmp_path / "b.csv")) is None
