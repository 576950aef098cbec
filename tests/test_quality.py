from __future__ import annotations

from tidemark.operators import quality


def outcome(df):
    return {r.check_name: (r.layer, r.failed_rows, r.total_rows, r.passed) for r in df.collect()}


def test_event_checks_count_bad_rows(spark):
    rows = [("a", "2024-01-01", "view"), (None, None, "VIEW"), ("a", None, None)]
    df = spark.createDataFrame(rows, "event_id string, event_ts string, event_type string")
    assert outcome(quality.check_events(df, "silver", ["view"])) == {
        "event_id_not_null": ("silver", 1, 3, False),
        "event_ts_not_null": ("silver", 2, 3, False),
        "event_type_valid": ("silver", 2, 3, False),
    }
    assert outcome(quality.check_unique(df, "silver")) == {"event_id_unique": ("silver", 1, 2, False)}


def test_checks_of_an_empty_table_pass(spark):
    df = spark.createDataFrame([], "event_id string, event_ts string, event_type string, product_id int")
    checks = quality.all_checks(
        [
            quality.check_events(df, "silver", ["view"]),
            quality.check_unique(df, "silver"),
            quality.check_reference(df, df),
        ]
    )
    assert {v[1:] for v in outcome(checks).values()} == {(0, 0, True)}


def test_missing_products_are_counted_by_fact_row(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "product_id bigint")
    dim = spark.createDataFrame([(2,), (3,)], "product_id bigint")
    assert outcome(quality.check_reference(facts, dim)) == {"product_id_in_dim": ("gold", 2, 3, False)}


def test_row_counts_that_do_not_add_up(spark):
    def rows(n):
        return spark.range(n).withColumnRenamed("id", "user_id")

    customers = spark.createDataFrame([(3,)], "total_events bigint")
    sessions = spark.createDataFrame([(2,), (2,)], "event_count bigint")
    got = outcome(quality.check_row_counts(rows(3), rows(4), rows(4), customers, sessions))
    assert got == {
        "silver_at_most_bronze": ("silver", 1, 3, False),
        "fact_equals_silver": ("gold", 0, 4, True),
        "customer_events_equal_silver": ("gold", 1, 4, False),
        "session_events_equal_fact": ("gold", 0, 4, True),
    }
