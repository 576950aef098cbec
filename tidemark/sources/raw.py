"""Raw event files: CSV with a header, every column text."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Error classes of Spark that mean "nothing to read there".
_NO_INPUT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def source_file() -> Column:
    """Path of the file a scanned row comes from, percent-encoded."""
    return F.col("_metadata.file_path")


def csv_options(pattern: str, skip_corrupt: bool = False) -> dict[str, str]:
    """Options of a raw scan: header row, nested folders, files picked by name.

    Columns of a headed CSV are matched by position, so files whose header differs from the
    declared schema must fail instead of being read misaligned: ``enforceSchema`` is off.
    """
    return {
        "header": "true",
        "inferSchema": "false",
        "multiLine": "false",
        "recursiveFileLookup": "true",
        "pathGlobFilter": pattern,
        "enforceSchema": "false",
        "ignoreCorruptFiles": str(skip_corrupt).lower(),
    }


def header_schema(spark: SparkSession, raw_dir: str, pattern: str = "*.csv") -> T.StructType:
    """All-text schema from the header of one matching file; no data row is read."""
    try:
        names = spark.read.options(**csv_options(pattern)).csv(raw_dir).columns
    except AnalysisException as error:
        if error.getCondition() in _NO_INPUT:
            raise FileNotFoundError(f"no input files match {pattern} under {raw_dir}") from error
        raise
    if not names:
        raise FileNotFoundError(f"no input files match {pattern} under {raw_dir}")
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_raw_events(
    spark: SparkSession,
    raw_dir: str,
    pattern: str = "*.csv",
    schema: T.StructType | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    """Scan every matching file below ``raw_dir``.

    A file whose header names or order differ fails the scan. ``skip_corrupt`` skips unreadable
    files silently, and with them any file with another header; use it only for equal headers.
    """
    declared = schema or header_schema(spark, raw_dir, pattern)
    return spark.read.schema(declared).options(**csv_options(pattern, skip_corrupt)).csv(raw_dir)


def literal_path(path: str) -> str:
    """A path that names one file, whatever characters of patterns it has."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def read_raw_files(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, skip_corrupt: bool = False
) -> DataFrame:
    """Scan the given files, whose header must be that of ``schema``, with the file a row comes from."""
    options = {k: v for k, v in csv_options("*", skip_corrupt).items() if k != "pathGlobFilter"}
    rows = spark.read.schema(schema).options(**options).csv([literal_path(path) for path in paths])
    # A union hides the file a row came from, so it is read here.
    return rows.select("*", source_file().alias("source_file"))


def read_header_groups(
    spark: SparkSession, raw_dir: str, patterns: Sequence[str], skip_corrupt: bool = False
) -> DataFrame:
    """Union of scans by column name, one pattern per group of files with the same header.

    A union hides the file a row came from, so ``source_file`` is read here.
    """
    groups = [
        read_raw_events(spark, raw_dir, p, skip_corrupt=skip_corrupt).select("*", source_file().alias("source_file"))
        for p in patterns
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)
