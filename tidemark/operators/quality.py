"""Data-quality checks: (check_name, layer, failed_rows, total_rows, passed), one row per check."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _result(df: DataFrame, name: Column, layer: str, failed: Column, total: Column) -> DataFrame:
    return df.select(
        name.alias("check_name"),
        F.lit(layer).alias("layer"),
        failed.cast("bigint").alias("failed_rows"),
        total.cast("bigint").alias("total_rows"),
        (failed == 0).alias("passed"),
    )


def _one_pass(df: DataFrame, layer: str, failures: dict[str, Column]) -> DataFrame:
    """Count the rows that meet each failure condition, all in one scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *(F.count_if(bad).alias(name) for name, bad in failures.items()),
    )
    checks = F.array(
        *(F.struct(F.lit(n).alias("name"), F.col(n).alias("failed")) for n in failures)
    )
    rows = counts.select("total_rows", F.explode(checks).alias("check"))
    return _result(rows, F.col("check.name"), layer, F.col("check.failed"), F.col("total_rows"))


def check_not_null(df: DataFrame, layer: str, columns: Sequence[str]) -> DataFrame:
    return _one_pass(df, layer, {f"{c}_not_null": F.col(c).isNull() for c in columns})


def check_event_type(df: DataFrame, layer: str, allowed: Sequence[str]) -> DataFrame:
    bad = ~F.coalesce(F.col("event_type").isin(*allowed), F.lit(False))
    return _one_pass(df, layer, {"event_type_valid": bad})


def check_events(df: DataFrame, layer: str, allowed_types: Sequence[str]) -> DataFrame:
    """The three row-level checks of an event table in a single scan."""
    return _one_pass(
        df,
        layer,
        {
            "event_id_not_null": F.col("event_id").isNull(),
            "event_ts_not_null": F.col("event_ts").isNull(),
            "event_type_valid": ~F.coalesce(F.col("event_type").isin(*allowed_types), F.lit(False)),
        },
    )


def check_unique(df: DataFrame, layer: str, key: str = "event_id") -> DataFrame:
    """Failed rows are those beyond the first of each non-null key."""
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    return _result(counts, F.lit(f"{key}_unique"), layer, F.col("surplus"), F.col("total"))


def check_reference(
    facts: DataFrame, dim: DataFrame, layer: str = "gold", key: str = "product_id"
) -> DataFrame:
    """Fact rows whose non-null key is missing from the dimension.

    Facts are counted per key before the join, so a key with very many rows is one row in it.
    """
    per_key = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(key).alias("_key"), F.lit(True).alias("_known"))
    counts = per_key.join(known, per_key[key] == known["_key"], "left").agg(
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    return _result(counts, F.lit(f"{key}_in_dim"), layer, F.col("missing"), F.col("total"))


def _figures(counts: DataFrame, **figures: Column) -> DataFrame:
    """(name, n) of some aggregates over a table."""
    named = counts.agg(*(F.coalesce(n, F.lit(0)).cast("bigint").alias(name) for name, n in figures.items()))
    return named.select(F.inline(F.array(*(F.struct(F.lit(name).alias("name"), F.col(name).alias("n")) for name in figures))))


def _wide(figures: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """One row of all figures."""
    return reduce(DataFrame.unionByName, figures).agg(
        *(F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in names)
    )


def _outcome(name: str, layer: str, failed: Column, total: str) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(layer).alias("layer"),
        failed.alias("failed_rows"),
        F.col(total).alias("total_rows"),
        (failed == 0).alias("passed"),
    )


def _relations() -> list[Column]:
    """How the layers' row counts must relate; failed rows are the size of the difference."""
    none = F.lit(0).cast("bigint")
    surplus = F.greatest(F.col("silver") - F.col("bronze"), none)
    apart = lambda a, b: F.abs(F.col(a) - F.col(b))
    return [
        _outcome("silver_at_most_bronze", "silver", surplus, "bronze"),
        _outcome("fact_equals_silver", "gold", apart("fact", "silver"), "silver"),
        _outcome("customer_events_equal_silver", "gold", apart("customer_events", "silver_with_user"), "silver_with_user"),
        _outcome("session_events_equal_fact", "gold", apart("session_events", "fact"), "fact"),
    ]


_COUNTED = ("bronze", "silver", "silver_with_user", "fact", "customer_events", "session_events")


def check_row_counts(
    bronze: DataFrame,
    silver: DataFrame,
    facts: DataFrame,
    customers: DataFrame,
    sessions: DataFrame,
) -> DataFrame:
    one = F.count(F.lit(1))
    figures = [
        _figures(bronze, bronze=one),
        _figures(silver, silver=one, silver_with_user=F.count("user_id")),
        _figures(facts, fact=one),
        _figures(customers, customer_events=F.sum("total_events")),
        _figures(sessions, session_events=F.sum("event_count")),
    ]
    return _wide(figures, _COUNTED).select(F.inline(F.array(*_relations())))


def check_lake(
    arrived: DataFrame,
    silver: DataFrame,
    facts: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    sessions: DataFrame,
    allowed_types: Sequence[str],
) -> DataFrame:
    """All checks, with one scan of every table: events are counted per id and facts per product before anything else.

    ``arrived`` are bronze rows with their event ids, and ``no_id`` where a native id is blank if the rows can have one.
    """
    one, n = F.count(F.lit(1)), F.col("n")
    native = "no_id" in arrived.columns
    blank = F.count_if("no_id") if native else F.lit(0)
    bad_type = ~F.coalesce(F.col("event_type").isin(*allowed_types), F.lit(False))
    known_id = F.col("event_id").isNotNull()
    per_arrived = arrived.groupBy("event_id").agg(one.alias("n"), blank.alias("blank"))
    per_event = silver.groupBy("event_id").agg(
        one.alias("n"),
        F.count_if(F.col("event_ts").isNull()).alias("no_time"),
        F.count_if(bad_type).alias("bad_type"),
        F.count("user_id").alias("with_user"),
    )
    per_product = facts.groupBy("product_id").agg(one.alias("n"))
    known = products.select(F.col("product_id").alias("known_id"))
    referring = per_product.join(known, F.col("product_id") == F.col("known_id"), "left")
    with_product = F.col("product_id").isNotNull()
    figures = [
        _figures(
            per_arrived,
            bronze=F.sum(n),
            bronze_ids=F.sum(F.when(known_id, n)),
            bronze_copies=F.sum(F.when(known_id, n - 1)),
            blank_ids=F.sum("blank"),
        ),
        _figures(
            per_event,
            silver=F.sum(n),
            silver_ids=F.sum(F.when(known_id, n)),
            silver_copies=F.sum(F.when(known_id, n - 1)),
            no_id=F.sum(F.when(~known_id, n)),
            no_time=F.sum("no_time"),
            bad_type=F.sum("bad_type"),
            silver_with_user=F.sum("with_user"),
        ),
        _figures(
            referring,
            fact=F.sum(n),
            fact_products=F.sum(F.when(with_product, n)),
            unknown_products=F.sum(F.when(with_product & F.col("known_id").isNull(), n)),
        ),
        _figures(customers, customer_events=F.sum("total_events")),
        _figures(sessions, session_events=F.sum("event_count")),
    ]
    names = (
        *_COUNTED, "bronze_ids", "bronze_copies", "blank_ids", "silver_ids", "silver_copies", "no_id", "no_time", "bad_type",
        "fact_products", "unknown_products",
    )
    outcomes = [
        _outcome("event_id_unique", "bronze", F.col("bronze_copies"), "bronze_ids"),
        *([_outcome("event_id_not_null", "bronze", F.col("blank_ids"), "bronze")] if native else []),
        _outcome("event_id_not_null", "silver", F.col("no_id"), "silver"),
        _outcome("event_ts_not_null", "silver", F.col("no_time"), "silver"),
        _outcome("event_type_valid", "silver", F.col("bad_type"), "silver"),
        _outcome("event_id_unique", "silver", F.col("silver_copies"), "silver_ids"),
        *_relations(),
        _outcome("product_id_in_dim", "gold", F.col("unknown_products"), "fact_products"),
    ]
    return _wide(figures, names).select(F.inline(F.array(*outcomes)))


def all_checks(results: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)
