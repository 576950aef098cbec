"""What the operators share: tables, shared scratch, and columns that cannot clash with the caller's."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import shared_dir

# The white space that the contracts name.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SPACE_CLASS = r"[\x20\x09-\x0D]"

# Two strings that differ in the case of A to Z only.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that go to a Python worker at once, unless the session sets another number. Spark's default of ten thousand
#: long texts, and what is made of them, would be most of a small executor's memory.
BATCH_ROWS, BATCH_SETTING, SPARK_BATCH_ROWS = "1000", "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(BATCH_SETTING) == SPARK_BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared scratch, removed when the application ends."""
    folder = f"{shared_dir(spark)}/{label}-{uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to shared scratch and read again: a lost executor costs no more than a read."""
    small_batches(df.sparkSession)
    folder = f"{scratch_folder(df.sparkSession, label)}/rows"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def as_row(df: DataFrame) -> Column:
    """All columns as one struct, so that added columns cannot clash with them."""
    return F.struct(*(F.col(f"`{name}`") for name in df.columns)).alias("doc")


def without_spaces(text: Column) -> Column:
    """``text`` without any character of ``SPACE_CLASS``; null becomes empty."""
    bare = F.coalesce(text, F.lit(""))
    for space in SPACES:
        bare = F.replace(bare, F.lit(space), F.lit(""))
    return bare
