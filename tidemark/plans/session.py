"""What the jobs expect of the caller's session."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Zone names that mean UTC.
UTC_NAMES = frozenset({"UTC", "Etc/UTC", "Z", "GMT", "+00:00"})


def require_utc(spark: SparkSession) -> None:
    """Raw times carry a literal 'UTC', so any other session zone would shift them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")
