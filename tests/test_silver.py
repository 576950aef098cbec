from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import MEDIUM
from checks.queries import bronze_rows
from tidemark.operators.dedupe import dedupe_events
from tidemark.operators.standardize import (
    clean_strings,
    stable_order,
    standardize_types,
    with_event_id,
)
from tidemark.plans.silver import keyed_events, silver_events

OLD, NEW = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_latest_ingest_wins_and_null_ingest_loses(spark):
    rows = [("a", OLD, "f", 1.0), ("a", NEW, "f", 2.0), ("a", None, "f", 3.0), ("b", None, "f", 4.0)]
    df = spark.createDataFrame(rows, "event_id string, ingest_ts timestamp, source_file string, price double")
    got = {r["event_id"]: r["price"] for r in dedupe_events(df).collect()}
    assert got == {"a": 2.0, "b": 4.0}


def test_ties_do_not_depend_on_input_order(spark):
    rows = [("a", OLD, f"f{i % 3}", float(i)) for i in range(30)]
    declared = "event_id string, ingest_ts timestamp, source_file string, price double"
    survivors = set()
    for parts, order in ((1, 1), (4, -1), (7, 1)):
        df = spark.createDataFrame(rows[::order], declared).repartition(parts)
        survivors.update(tuple(r) for r in dedupe_events(df).collect())
    assert len(survivors) == 1
    assert next(iter(survivors))[2:] == ("f0", 0.0)


def test_without_ingest_time_one_row_per_id_is_left(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "event_id string, x int")
    assert sorted(str(r[0]) for r in dedupe_events(df).collect()) == ["None", "a", "b"]


def test_silver_of_shuffled_bronze_is_the_same(spark):
    bronze = bronze_rows(spark, MEDIUM)
    one = silver_events(bronze)
    other = silver_events(bronze.repartition(5, F.rand(3)))
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_types_follow_the_columns_that_exist(spark):
    df = spark.createDataFrame(
        [("2019-10-01 00:00:00 UTC", "3", "9.5", "12.7", "keep")],
        "event_time string, quantity string, amount string, user_id string, extra string",
    )
    typed = standardize_types(clean_strings(df))
    assert dict(typed.dtypes) == {
        "event_time": "string",
        "quantity": "int",
        "amount": "double",
        "user_id": "bigint",
        "extra": "string",
        "event_ts": "timestamp",
        "event_date": "date",
    }
    row = typed.first()
    assert (row.quantity, row.amount, row.user_id, str(row.event_date)) == (3, 9.5, 12, "2019-10-01")

    untimed = standardize_types(spark.createDataFrame([("a",)], "brand string"))
    assert untimed.columns == ["brand"]


def test_a_later_time_column_is_used_if_it_is_the_only_one(spark):
    df = spark.createDataFrame([("2019-10-01T01:02:03Z",)], "event_timestamp string")
    assert str(standardize_types(df).first().event_date) == "2019-10-01"


def test_a_given_date_is_kept(spark):
    df = spark.createDataFrame([("2019-10-01 00:00:00", "2020-02-02")], "event_ts string, event_date string")
    assert str(standardize_types(df).first().event_date) == "2020-02-02"


def test_native_event_id_is_kept(spark):
    df = spark.createDataFrame([("x", 1)], "event_id string, user_id bigint")
    assert with_event_id(df).first().event_id == "x"


def test_column_order(spark):
    df = spark.createDataFrame([(1,) * 5], "zeta int, price int, extra int, event_id int, user_id int")
    assert stable_order(df).columns == ["event_id", "user_id", "price", "zeta", "extra"]


def test_events_without_any_key_field_share_one_id(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, OLD), ("  ", " ", None, "x", NEW)],
        "user_id string, event_type string, event_ts string, product_id string, ingest_ts timestamp",
    )
    assert keyed_events(df).select("event_id").distinct().count() == 1
    assert silver_events(df).count() == 1
