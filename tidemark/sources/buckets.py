"""Append-only tables whose files are bucketed by a key, so that a join on it moves the other side only."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.files import names_in


def append_bucketed(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """Add rows to the files at ``path``. The table in the session's catalog that Spark asks for goes again, the files stay."""
    spark, name = rows.sparkSession, f"tidemark_{uuid4().hex}"
    try:
        writer = rows.write.format("parquet").bucketBy(buckets, key).option("path", path).mode("append")
        if names_in(spark, path):
            _declare(spark, name, path, rows.schema, key, buckets)
            writer.saveAsTable(name)
        else:
            writer.saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    if not names_in(spark, path):
        return spark.createDataFrame([], schema)
    name = f"tidemark_{uuid4().hex}"
    _declare(spark, name, path, schema, key, buckets)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _declare(spark: SparkSession, name: str, path: str, schema: T.StructType, key: str, buckets: int) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'")
