from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ingest import stamp_ingestion
from tidemark.operators.inspect import column_profile, first_dates, sample_rows
from tidemark.plans import run_bronze
from tidemark.sources.raw import read_header_groups, read_raw_events
from tidemark.sources.tables import read_table, write_table

HEADER = "event_time,event_type,product_id,price,user_id"


def put(folder, name, *lines):
    file = folder / name
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text("\n".join(lines) + "\n")


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    put(
        folder,
        "2019-Oct.csv",
        HEADER,
        "2019-10-01 00:00:00 UTC,view,1,2.5,7",
        "garbage,view,2,,8",
        "2019-10-02 00:00:00 UTC,cart,1,2.5,7",
    )
    put(folder, "deep/er/2019-Nov.csv", HEADER, "2019-11-01 00:00:00 UTC,view,1,2.5,7")
    put(folder, "notes.txt", "not,an,event")
    return folder


def test_nested_files_are_found_by_name(spark, raw):
    assert read_raw_events(spark, str(raw)).count() == 4
    assert read_raw_events(spark, str(raw), "*Nov*").count() == 1
    assert set(dict(read_raw_events(spark, str(raw)).dtypes).values()) == {"string"}


def test_no_input_is_an_error(spark, raw, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw_events(spark, str(raw), "*.tsv")
    with pytest.raises(FileNotFoundError):
        read_raw_events(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "nowhere"))


def test_bronze_table(spark, raw, tmp_path):
    out = str(tmp_path / "bronze")
    instant = datetime(2024, 1, 1, tzinfo=timezone.utc)
    assert run_bronze(spark, str(raw), out, ingested_at=instant) == 4
    table = read_table(spark, out)
    assert table.columns == [*HEADER.split(","), "source_file", "ingest_ts", "event_ts", "event_date"]
    assert table.select("ingest_ts").distinct().count() == 1
    sources = {r[0].rsplit("/", 1)[1] for r in table.select("source_file").distinct().collect()}
    assert sources == {"2019-Oct.csv", "2019-Nov.csv"}
    undated = table.filter("event_date is null").collect()
    assert [r.event_time for r in undated] == ["garbage"]
    assert [(str(r.event_date), r.row_count) for r in first_dates(table).collect()] == [
        ("None", 1),
        ("2019-10-01", 1),
        ("2019-10-02", 1),
        ("2019-11-01", 1),
    ]
    run_bronze(spark, str(raw), out)
    assert read_table(spark, out).count() == 8
    run_bronze(spark, str(raw), out, mode="overwrite", gather=False)
    assert read_table(spark, out).count() == 4


def test_another_header_order_is_never_read_misaligned(spark, raw, tmp_path):
    put(raw, "2019-Dec.csv", "user_id,event_time,event_type,product_id,price", "7,2019-12-01,view,1,2.5")
    with pytest.raises(Exception, match="(?i)header"):
        run_bronze(spark, str(raw), str(tmp_path / "bronze"))
    grouped = stamp_ingestion(read_header_groups(spark, str(raw), ["*Oct.csv", "*Nov.csv", "*Dec.csv"]))
    assert grouped.count() == 5
    december = grouped.filter(F.col("source_file").endswith("Dec.csv")).first()
    assert (december.user_id, str(december.event_date)) == ("7", "2019-12-01")


def test_the_instant_is_the_same_for_every_action(spark, raw):
    stamped = stamp_ingestion(read_raw_events(spark, str(raw)))
    assert stamped.first().ingest_ts == stamped.first().ingest_ts


def test_other_zones_are_refused(spark, raw, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError, match="UTC"):
            run_bronze(spark, str(raw), str(tmp_path / "bronze"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_profile_and_sample(spark, raw):
    df = read_raw_events(spark, str(raw))
    profile = {r.column_name: (r.data_type, r.non_null, r.total_rows) for r in column_profile(df).collect()}
    assert profile["price"] == ("string", 3, 4)
    assert profile["event_time"] == ("string", 4, 4)
    assert sample_rows(df, 2).count() == 2
    assert sample_rows(df, 100).count() == df.count()


def test_a_partitioned_write_makes_one_file_per_small_date(spark, tmp_path):
    out = tmp_path / "t"
    df = spark.range(3000, numPartitions=8).select(
        "id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("event_date")
    )
    write_table(df, str(out))
    assert len(list(out.glob("*/event_date=*/*.parquet"))) == 30


def test_unreadable_files_fail_unless_skipped(spark, raw, tmp_path):
    (raw / "broken.csv.gz").write_bytes(b"\x1f\x8b\x08\x00not really")
    schema = read_raw_events(spark, str(raw), "*.csv").schema
    out = str(tmp_path / "bronze")
    with pytest.raises(Exception, match="(?i)failed"):
        run_bronze(spark, str(raw), out, "*.csv*", schema=schema)
    assert run_bronze(spark, str(raw), out, "*.csv*", "overwrite", schema, skip_corrupt=True) == 4

    table = read_table(spark, out).drop("event_date")
    write_table(table, str(tmp_path / "t"))
    (next((tmp_path / "t").glob("_write=*")) / "part-broken.parquet").write_bytes(b"PAR1 no")
    with pytest.raises(Exception):  # noqa: B017
        read_table(spark, str(tmp_path / "t"), table.schema).collect()
    assert len(read_table(spark, str(tmp_path / "t"), table.schema, skip_corrupt=True).collect()) == 4


def test_an_empty_table_is_written(spark, tmp_path):
    nothing = spark.range(10).filter("id > 99").groupBy("id").count()
    assert write_table(nothing, str(tmp_path / "t")) == 0
    assert read_table(spark, str(tmp_path / "t")).columns == ["id", "count"]
