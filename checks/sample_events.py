"""Shop events made from the given test tables, whole, in three shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Raw CSV columns, in file order.
RAW_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _product(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("bigint")


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events without a native id: the stream table with labels from ``part``."""
    events = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.to_date("ts").alias("event_date"),
        "event_type",
        "user_id",
        _product(F.col("props")).alias("product_id"),
        F.col("value").alias("price"),
    )
    labels = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category_code"),
        F.col("p_brand").alias("brand"),
    )
    return events.join(labels, "product_id", "left")


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as events: a bulk load with quantities and many equal times."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .join(parts, lines["l_partkey"] == parts["p_partkey"], "left")
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").cast("timestamp").alias("event_ts"),
            F.to_date("o_orderdate").alias("event_date"),
            F.lit("order").alias("event_type"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            F.col("p_type").alias("category_code"),
            F.col("p_brand").alias("brand"),
        )
    )


def raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as raw text with faults set by its number, plus its ``drop_no``.

    Drop 1 holds all events but late ones; drop 2 the late events and second copies of others
    with another price.
    """
    number = F.col("event_id")

    def nth(n: int) -> Column:
        return number % n == 0

    time_text = (
        F.when(nth(97), "garbage")
        .when(nth(89), "   ")
        .when(number % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss 'UTC'"))
        .when(number % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )
    type_text = (
        F.when(nth(19), "  ")
        .when(nth(5), F.concat(F.lit("  "), F.upper("event_type"), F.lit(" ")))
        .otherwise(F.col("event_type"))
    )
    product = _product(F.col("props")).cast("string")
    product_text = (
        F.when(nth(17), "abc").when(nth(7), F.concat(product, F.lit(".7"))).otherwise(product)
    )
    events = table(spark, sf_dir, "events")
    labels = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("_part"), "p_type", "p_brand"
    )
    first = events.join(labels, _product(F.col("props")) == F.col("_part"), "left").select(
        number,
        time_text.alias("event_time"),
        type_text.alias("event_type"),
        product_text.alias("product_id"),
        F.when(~nth(23), F.col("p_type")).alias("category_code"),
        F.concat(F.lit(" "), F.col("p_brand")).alias("brand"),
        F.when(nth(29), "n/a").otherwise(F.col("value").cast("string")).alias("price"),
        F.when(nth(13), " ").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        number.cast("string").alias("user_session"),
        F.when(number % 10 == 7, 2).otherwise(1).alias("drop_no"),
    )
    again = first.filter((number % 10 == 3) & F.col("price").isNotNull()).withColumns(
        {"price": F.lit("1.25"), "drop_no": F.lit(2)}
    )
    return first.unionByName(again).select(*RAW_COLUMNS, "drop_no")


def native_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw clicks with a native event id: blank for some, the same for others that are nine numbers apart.

    Category, quantity and amount come as text, so that every numeric column is parsed.
    """
    number = F.col("user_session").cast("bigint")
    native = F.when(number % 11 == 0, F.lit("  ")).when(
        number % 10 == 9, F.concat(F.lit("e"), (number - 9).cast("string"))
    ).otherwise(F.concat(F.lit(" e"), number.cast("string")))
    return raw_clicks(spark, sf_dir).withColumns(
        {
            "event_id": native,
            "category_id": F.when(number % 23 == 0, "12.0").otherwise((number % 50).cast("string")),
            "quantity": F.when(number % 31 == 0, "x").otherwise(F.concat((number % 4).cast("string"), F.lit(".9"))),
            "amount": F.when(number % 37 == 0, "").otherwise(F.concat((number % 9).cast("string"), F.lit(".5"))),
        }
    )
