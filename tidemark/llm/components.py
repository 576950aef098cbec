"""Connected components by alternating large and small stars, each round two shuffles of the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

MAX_ROUNDS = 60


def _starred(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Neighbours of each node hung on its smallest one; of larger neighbours only if ``both_ways``."""
    around = edges
    if both_ways:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(
        around.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("node"), F.least("u", "low").alias("low")),
        "least",
    )
    met = around.join(least, F.col("u") == F.col("node"))
    hung = met.filter(F.col("v") > F.col("u") if both_ways else F.col("v") != F.col("low")).select(
        F.col("v").alias("u"), F.col("low").alias("v")
    )
    if not both_ways:
        hung = hung.unionByName(least.select(F.col("node").alias("u"), F.col("low").alias("v")))
    return hung.filter("u <> v").distinct()


def roots(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node that has a link."""
    edges = staged(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(),
        "edges",
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        edges = staged(_starred(staged(_starred(edges, True), "large"), False), "small")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components have not settled in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
