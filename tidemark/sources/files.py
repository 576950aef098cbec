"""Questions and requests to the file system behind a path."""

from __future__ import annotations

from typing import Any
from uuid import uuid4

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str) -> tuple[Any, Any]:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return location.getFileSystem(conf), location


def path_exists(spark: SparkSession, path: str) -> bool:
    files, location = _located(spark, path)
    return files.exists(location)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no such folder."""
    files, location = _located(spark, path)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def read_text(spark: SparkSession, path: str) -> str:
    files, location = _located(spark, path)
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, which may be compressed; null if the file is empty."""
    files, location = _located(spark, path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(files.getConf()).getCodec(location)
    stream = files.open(location)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(plain, "UTF-8"))
        return lines.readLine()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Make a file that is not there yet: all of it appears at once, or nothing."""
    files, location = _located(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(location.getParent(), f".{uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(location) or not files.rename(draft, location):
        files.delete(draft, False)
        raise FileExistsError(f"{path} was written by someone else")


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Remove a folder, which need not be there yet, when the application ends."""
    files, location = _located(spark, path)
    there = files.exists(location)
    files.mkdirs(location)
    files.deleteOnExit(location)
    if not there:
        files.delete(location, True)


def delete_folder(spark: SparkSession, path: str) -> None:
    files, location = _located(spark, path)
    files.delete(location, True)
