"""Tables are published whole: writes that break off, readers under way, and what was added since a version."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.sources import tables, versions
from tidemark.sources.tables import (
    note,
    read_added,
    read_table,
    replace_dates,
    version_of,
    write_table,
)


def dated(spark, *rows):
    schema = "x int, event_date date"
    return spark.createDataFrame([(x, day and datetime.date.fromisoformat(day)) for x, day in rows], schema)


def numbers(df):
    return sorted(r.x for r in df.collect())


def folders(path):
    return sorted(str(f.relative_to(path)) for f in path.glob("_write=*/event_date=*"))


@pytest.fixture
def path(tmp_path):
    return tmp_path / "t"


@pytest.mark.parametrize("mode", ["overwrite", "append", "replace"])
@pytest.mark.parametrize("moment", ["rows", "version"])
def test_a_write_that_breaks_off_changes_nothing(spark, path, monkeypatch, mode, moment):
    write_table(dated(spark, (1, "2024-01-01"), (2, None)), str(path))
    before = version_of(spark, str(path))

    def write(rows):
        if mode == "replace":
            replace_dates(rows, str(path), ["2024-01-01"])
        else:
            write_table(rows, str(path), mode)

    fresh = dated(spark, (3, "2024-01-01"))
    if moment == "rows":
        with pytest.raises(Exception, match="lost"):
            write(fresh.withColumn("x", F.raise_error(F.lit("lost")).cast("int")))
    else:
        with monkeypatch.context() as patch:
            patch.setattr(tables, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError, match="lost"):
                write(fresh)
    assert version_of(spark, str(path)) == before
    assert numbers(read_table(spark, str(path))) == [1, 2]
    # The next write removes what the broken one has left.
    write(fresh)
    assert numbers(read_table(spark, str(path))) == {"overwrite": [3], "append": [1, 2, 3], "replace": [2, 3]}[mode]
    known = version_of(spark, str(path))
    assert set(folders(path)) <= known.folders() | set(known.retired)


def test_readers_under_way_see_the_version_they_began_with(spark, path):
    write_table(dated(spark, (1, "2024-01-01"), (2, "2024-01-02")), str(path))
    reader = read_table(spark, str(path))
    replace_dates(dated(spark, (10, "2024-01-01")), str(path), ["2024-01-01"])
    assert numbers(reader) == [1, 2]
    assert numbers(read_table(spark, str(path))) == [2, 10]
    later = read_table(spark, str(path))
    write_table(dated(spark, (7, "2024-01-05")), str(path))
    assert numbers(later) == [2, 10] and numbers(read_table(spark, str(path))) == [7]
    # Two versions on, the first folders are gone.
    write_table(dated(spark, (8, "2024-01-05")), str(path))
    assert len(folders(path)) == 2


def test_a_table_may_replace_its_dates_from_itself(spark, path):
    write_table(dated(spark, (1, "2024-01-01"), (2, "2024-01-02")), str(path))
    mine = read_table(spark, str(path), parts=["2024-01-02"])
    replace_dates(mine.withColumn("x", F.col("x") + 5), str(path), ["2024-01-02"])
    assert numbers(read_table(spark, str(path))) == [1, 7]
    replace_dates(mine.limit(0), str(path), ["2024-01-02", None])
    assert numbers(read_table(spark, str(path))) == [1]
    with pytest.raises(ValueError, match="2024-01-01"):
        replace_dates(read_table(spark, str(path)), str(path), ["2024-01-09"])


def test_what_was_added_since_a_version(spark, path):
    for x in (1, 2, 3):
        write_table(dated(spark, (x, f"2024-01-0{x}"), (10 * x, None)), str(path), "append")
    assert numbers(read_added(spark, str(path), 1)) == [2, 3, 20, 30]
    assert numbers(read_added(spark, str(path), 3)) == []
    assert read_added(spark, str(path), None) is None and read_added(spark, str(path), 9) is None
    assert version_of(spark, str(path)).changed_parts(2) == {"2024-01-03", tables.UNDATED}
    note(spark, str(path), {"a": 1})
    assert numbers(read_added(spark, str(path), 2)) == [3, 30]
    assert version_of(spark, str(path)).notes == {"a": 1}
    replace_dates(dated(spark, (5, "2024-01-01")), str(path), ["2024-01-01"])
    assert read_added(spark, str(path), 2) is None
    write_table(dated(spark, (6, None)), str(path))
    assert read_added(spark, str(path), 5) is None and version_of(spark, str(path)).changed_parts(5) is None


def test_changes_beyond_the_list_are_unknown(spark, path, monkeypatch):
    monkeypatch.setattr(tables, "LISTED_CHANGES", 2)
    for x in range(4):
        write_table(dated(spark, (x, None)), str(path), "append")
    assert read_added(spark, str(path), 1) is None
    assert numbers(read_added(spark, str(path), 2)) == [2, 3]


def test_a_date_can_be_hidden(spark, path):
    write_table(dated(spark, (1, "2024-01-01"), (2, None)), str(path), hidden_date=True)
    assert read_table(spark, str(path)).columns == ["x"]
    assert numbers(read_table(spark, str(path), parts=[None])) == [2]
    replace_dates(dated(spark, (3, None)), str(path), [None], hidden_date=True)
    assert numbers(read_table(spark, str(path))) == [1, 3]
    assert read_table(spark, str(path)).columns == ["x"]


def test_a_second_writer_fails(spark, tmp_path):
    folder = str(tmp_path / "v")
    for number in range(1, 7):
        versions.publish(spark, folder, number, {"n": number})
    assert versions.latest(spark, folder) == (6, {"n": 6})
    assert len(versions._numbers(spark, folder)) == versions.KEPT
    with pytest.raises(FileExistsError):
        versions.publish(spark, folder, 6, {"n": "other"})
    assert versions.latest(spark, folder) == (6, {"n": 6})


def test_files_of_others_are_not_appended_to(spark, path):
    dated(spark, (1, None)).write.parquet(str(path))
    with pytest.raises(ValueError, match="no version"):
        write_table(dated(spark, (2, None)), str(path), "append")
    assert numbers(read_table(spark, str(path))) == [1]


def test_dates_prune_the_scan(spark, path):
    write_table(dated(spark, (1, "2024-01-01"), (2, "2024-01-02")), str(path))
    replace_dates(dated(spark, (3, "2024-01-02")), str(path), ["2024-01-02"])
    plan = read_table(spark, str(path)).filter("event_date = date '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert len(read_table(spark, str(path), parts=["2024-01-01"]).inputFiles()) == 1
