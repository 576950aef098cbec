"""Published states: small JSON files, numbered; the highest number is the one that counts.

A state is published by making its file, which appears whole or not at all. Readers see the state before or the one
after, and a writer that breaks off leaves the state before. One writer at a time; a second one fails.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession

from tidemark.sources.files import delete_folder, names_in, read_text, write_new

SUFFIX = ".json"
#: States that stay for readers that have just looked up their number.
KEPT = 3


def _number(name: str) -> int | None:
    stem = name.removesuffix(SUFFIX)
    return int(stem) if name.endswith(SUFFIX) and stem.isdigit() else None


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(n for n in map(_number, names_in(spark, folder)) if n is not None)


def _file(folder: str, number: int) -> str:
    return f"{folder}/{number:012d}{SUFFIX}"


def latest(spark: SparkSession, folder: str) -> tuple[int, dict[str, Any]] | None:
    """Number and content of the published state, null if there is none."""
    numbers = _numbers(spark, folder)
    return (numbers[-1], json.loads(read_text(spark, _file(folder, numbers[-1])))) if numbers else None


def publish(spark: SparkSession, folder: str, number: int, state: dict[str, Any]) -> None:
    """Make ``state`` the one that counts, under a number above all others."""
    write_new(spark, _file(folder, number), json.dumps(state))
    for old in _numbers(spark, folder):
        if old <= number - KEPT:
            delete_folder(spark, _file(folder, old))


def publish_next(spark: SparkSession, folder: str, state: dict[str, Any]) -> None:
    before = latest(spark, folder)
    publish(spark, folder, 1 + (before[0] if before else 0), state)
