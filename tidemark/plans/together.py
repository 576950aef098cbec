"""Independent writes at the same time, so that one fills the cores another leaves idle."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, *jobs: Callable[[], Any]) -> list[Any]:
    """Run the jobs and return their results in order; all end before the first error is raised."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in started]
