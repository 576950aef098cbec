"""A corpus pipeline of the operators: each stage reads what its predecessor kept.

Toxic documents go, then copies, then all but one document of each group of near copies, then documents that
contain benchmark items; the last stage draws from the rest by calibrated weights.

Rules for odd input are those of the operators: null and empty texts are clean, are copies of each other, link with nothing
and match no benchmark item, and are not drawn, as they have no tokens; rows that share an id are kept or dropped by their own
texts, but as near copies stand or fall together; rows without an id are near copies of nothing that is dropped; texts of any length are
read whole; extra columns pass through all stages, whatever their names; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, exact_dedup, mixing, ngram_join, toxicity
from tidemark.llm.common import staged, table
from tidemark.llm.queries import MIX_FRACTION, MIX_TARGETS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits on the labelled rows among ``docs``, and keeps what scores below the rejection."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs, MIX_TARGETS, MIX_FRACTION)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing", mixed),
]

#: SQL can express neither the scan for toxic segments, nor string tiling, nor raking to convergence.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
