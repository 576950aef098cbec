"""Counts and profiles of a layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per_date(events: DataFrame) -> DataFrame:
    """Rows per ``event_date``; rows without a date are a group of their own."""
    return events.groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"))


def first_dates(events: DataFrame, n: int = 20) -> DataFrame:
    """The report of the earliest dates: null first, then ascending."""
    return rows_per_date(events).orderBy(F.col("event_date").asc_nulls_first()).limit(n)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def column_profile(df: DataFrame) -> DataFrame:
    """Type and non-null count of every column, from one aggregation over the table."""
    types = dict(df.dtypes)
    names = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(types[c]).alias("data_type"),
                F.col(f"c{i}").alias("non_null"),
                F.col("_rows").alias("total_rows"),
            )
            for i, c in enumerate(names)
        )
    )
    return counts.select(F.inline(rows))
