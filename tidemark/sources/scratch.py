"""Scratch space that every executor can reach."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import delete_at_end, delete_folder

SHARED_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the cluster, or a temporary one if Spark runs on this machine only."""
    named = spark.conf.get(SHARED_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tidemark-")
    delete_at_end(spark, made)
    spark.sparkContext.setCheckpointDir(made)
    return made


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder in shared scratch, which is removed when the application ends, if not before."""
    folder = f"{shared_dir(spark)}/{label}-{uuid4().hex}"
    delete_at_end(spark, folder)
    return folder


def stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder, compression="zstd")
    return df.sparkSession.read.parquet(folder)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to shared scratch and read it back, so its lineage ends at stored files."""
    return stored(df, new_folder(df.sparkSession, label))


@contextmanager
def staging_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A new folder in shared scratch that is removed when the work that uses it has ended."""
    folder = new_folder(spark, label)
    try:
        yield folder
    finally:
        delete_folder(spark, folder)
