from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    blank_to_null,
    event_key,
    floating_number,
    is_purchase,
    parse_event_time,
    price_band,
    whole_number,
)


def applied(spark, expression, values, column="x", type_name="string"):
    """The expression's value for each input, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {column} {type_name}")
    return [r["y"] for r in df.select("i", expression.alias("y")).orderBy("i").collect()]


def test_event_time_layouts(spark):
    raw = [
        "2019-10-01 00:00:00 UTC",
        "2019-10-01 00:00:01",
        "2019-10-01T00:00:02Z",
        "2019-10-01",
        "garbage",
        "",
        None,
    ]
    text = parse_event_time(F.col("x")).cast("string")
    assert applied(spark, text, raw) == [
        "2019-10-01 00:00:00",
        "2019-10-01 00:00:01",
        "2019-10-01 00:00:02",
        "2019-10-01 00:00:00",
        None,
        None,
        None,
    ]


def test_only_spaces_are_trimmed(spark):
    got = applied(spark, blank_to_null(F.col("x")), ["  a ", "   ", "", "\t a \t", None])
    assert got == ["a", None, None, "\t a \t", None]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("12", 12),
        ("12.7", 12),
        (" 7 ", 7),
        ("-3.9", -3),
        ("5.", 5),
        ("+7", 7),
        ("-0.5", 0),
        (".5", None),
        ("1e3", None),
        ("abc", None),
        ("", None),
        (None, None),
        ("1487580009496313889", 1487580009496313889),
        ("99999999999999999999", None),
    ],
)
def test_whole_numbers(spark, text, number):
    assert applied(spark, whole_number(F.col("x"), "bigint"), [text]) == [number]


def test_numbers_out_of_range_are_null(spark):
    assert applied(spark, whole_number(F.col("x"), "int"), ["3000000000", "7"]) == [None, 7]
    assert applied(spark, floating_number(F.col("x")), ["1e3", " 2.5 ", "x", None]) == [
        1000.0,
        2.5,
        None,
        None,
    ]


def test_event_key_hashes_text_of_present_fields(spark):
    row = (8, datetime(2024, 1, 1, 0, 0, 7, 500000), "view", None)
    declared = "user_id bigint, event_ts timestamp, event_type string, product_id bigint"
    df = spark.createDataFrame([row, (None, None, None, None)], declared)
    got = [r[0] for r in df.select(event_key(df.columns)).collect()]
    first = df.select(F.col("event_ts").cast("string")).first()[0]
    expected = [f"8||{first}||view||", "||||||"]
    assert got == [hashlib.sha256(t.encode()).hexdigest() for t in expected]

    bare = df.select("event_type")
    keys = [r[0] for r in bare.select(event_key(bare.columns)).collect()]
    assert keys[0] == hashlib.sha256(b"||||view||").hexdigest()


def test_purchase_is_matched_anywhere(spark):
    types = ["Purchase ", "reorder", "border_view", "buyer_login", "remove_from_cart", None]
    got = applied(spark, is_purchase(), types, column="event_type")
    assert got == [True, True, True, True, False, False]


def test_price_band_edges(spark):
    prices = [None, -1.0, 9.99, 10.0, 49.99, 50.0, 99.99, 100.0, float("nan")]
    got = applied(spark, price_band(F.col("x")), prices, type_name="double")
    assert got == [
        "unknown",
        "under_10",
        "under_10",
        "10_to_50",
        "10_to_50",
        "50_to_100",
        "50_to_100",
        "100_plus",
        "100_plus",
    ]
