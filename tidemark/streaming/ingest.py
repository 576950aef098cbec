"""Ingest raw files that were not ingested before."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ingest import now_utc, stamp_ingestion
from tidemark.sources.files import first_line, path_exists, read_text
from tidemark.sources.raw import csv_options, header_schema, literal_path, read_raw_files
from tidemark.sources.tables import Version, note, version_of, write_table

# A file stream leaves out files much older than the newest one it has seen. No file is as old as this.
NEVER_TOO_OLD = "36500d"
#: What the stream lists of a file; the content is never asked for.
_FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
TIME_COLUMN = "event_time"
#: Notes of a bronze table: the last step per stream, files set aside with their columns, and the raw columns it takes.
STEPS, SET_ASIDE, RAW_COLUMNS = "steps", "set_aside", "raw_columns"
HEADER_READERS = 16
# Columns that ingestion adds.
STAMPED = ("source_file", "ingest_ts", "event_ts", "event_date")


def _notes(version: Version | None) -> dict[str, Any]:
    return version.notes if version else {}


def set_aside(spark: SparkSession, bronze_dir: str) -> dict[str, list[str]]:
    """Raw files that were not ingested because of their columns."""
    return dict(_notes(version_of(spark, bronze_dir)).get(SET_ASIDE, {}))


def _headers(spark: SparkSession, paths: Sequence[str], skip_corrupt: bool) -> dict[str, list[str]]:
    """Files by their first line, of which the driver reads no more; empty files are left out."""

    def line_of(path: str) -> str | None:
        try:
            return first_line(spark, path)
        except Exception:
            if skip_corrupt:
                return None
            raise

    with ThreadPoolExecutor(HEADER_READERS) as pool:
        lines = list(pool.map(line_of, paths))
    by_line: dict[str, list[str]] = {}
    for path, line in zip(paths, lines, strict=True):
        if line:
            by_line.setdefault(line, []).append(path)
    return by_line


def _read(
    spark: SparkSession, paths: Sequence[str], known: list[str] | None, pattern: str, widen: bool, skip_corrupt: bool
) -> tuple[DataFrame | None, list[str], dict[str, list[str]]]:
    """The rows of some files, the raw columns the table then has, and the files that do not fit it with their columns.

    Files are read in groups of equal headers, by name, so the order of columns may differ and some may be missing.
    """
    groups, odd = [], {}
    for line, files in _headers(spark, paths, skip_corrupt).items():
        columns = header_schema(spark, literal_path(files[0]), pattern).names
        known = known or columns
        if TIME_COLUMN not in columns or (set(columns) - set(known) and not widen):
            odd |= dict.fromkeys(files, columns)
            continue
        known = [*known, *(c for c in columns if c not in known)]
        groups.append(read_raw_files(spark, files, T.StructType([T.StructField(c, T.StringType()) for c in columns]), skip_corrupt))
    if not groups:
        return None, known or [], odd
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)
    return rows, known, odd


def _ingest(
    spark: SparkSession,
    paths: Sequence[str],
    bronze_dir: str,
    pattern: str,
    schema: T.StructType | None,
    instant: datetime,
    widen: bool,
    skip_corrupt: bool,
    steps: dict[str, int],
) -> None:
    """Append the rows of files, in one version that also says which step is done and what was set aside."""
    version = version_of(spark, bronze_dir)
    notes = _notes(version)
    known = notes.get(RAW_COLUMNS) or (schema.names if schema else None)
    if known is None and version:
        known = [name for name in version.schema.names if name not in STAMPED]
    rows, known, odd = _read(spark, sorted(paths), known, pattern, widen, skip_corrupt)
    aside = {path: c for path, c in notes.get(SET_ASIDE, {}).items() if path not in set(paths)} | odd
    noted = {STEPS: {**notes.get(STEPS, {}), **steps}, SET_ASIDE: aside, RAW_COLUMNS: known}
    if rows is not None:
        stamped = stamp_ingestion(rows, instant)
        write_table(stamped, bronze_dir, "append", widen=True, notes={**noted, "through": int(instant.timestamp() * 1_000_000)})
    elif version:
        note(spark, bronze_dir, noted)


def _stream_id(spark: SparkSession, checkpoint_dir: str) -> str:
    return json.loads(read_text(spark, f"{checkpoint_dir}/metadata"))["id"]


def _check(spark: SparkSession, bronze_dir: str, checkpoint_dir: str) -> None:
    if _notes(version_of(spark, bronze_dir)).get(STEPS) and not path_exists(spark, f"{checkpoint_dir}/offsets"):
        raise ValueError(f"{bronze_dir} was filled by a stream whose checkpoint is gone")


def ingest_new_files(
    spark: SparkSession,
    raw_dir: str,
    bronze_dir: str,
    checkpoint_dir: str,
    pattern: str = "*.csv",
    schema: T.StructType | None = None,
    ingested_at: datetime | None = None,
    files_per_batch: int | None = None,
    skip_corrupt: bool = False,
    widen: bool = False,
) -> StreamingQuery:
    """Append the rows of unseen raw files to bronze, each file exactly once, and wait for the end.

    A stream lists the files; its checkpoint is the list of those seen, whatever their modification times. A step reads
    its files by their headers and publishes the rows together with its own number, so a step that is repeated after a
    crash is known to be done. Files with columns that bronze does not have are set aside, unless ``widen`` adds these, and tried again by
    each run. All rows of one run share ``ingest_ts``.
    """
    _check(spark, bronze_dir, checkpoint_dir)
    if not path_exists(spark, checkpoint_dir) and schema is None:
        header_schema(spark, raw_dir, pattern)  # nothing to read there is an error at first
    instant = ingested_at or now_utc()
    arguments = (bronze_dir, pattern, schema, instant, widen, skip_corrupt)
    waiting = [path for path in set_aside(spark, bronze_dir) if path_exists(spark, path)]
    if waiting:
        _ingest(spark, waiting, *arguments, {})

    def step(files: DataFrame, number: int) -> None:
        stream = _stream_id(spark, checkpoint_dir)
        done = _notes(version_of(spark, bronze_dir)).get(STEPS, {}).get(stream, -1)
        if number > done:
            # The driver has listed these files; ``files_per_batch`` bounds how many a step takes.
            paths = [row.path for row in files.select("path").collect()]
            _ingest(spark, paths, *arguments, {stream: number})

    options = {
        name: value for name, value in csv_options(pattern).items() if name in ("recursiveFileLookup", "pathGlobFilter")
    }
    if files_per_batch:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    query = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .options(**options, maxFileAge=NEVER_TOO_OLD)
        .load(raw_dir)
        .select("path")
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
