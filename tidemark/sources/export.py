"""Gold tables as CSV for loading elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Spark's defaults cut times to milliseconds, strip spaces and escape quotes with a backslash.
LOSSLESS = {
    "header": "true",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
}


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV part with a header per task, written where the rows are; nothing is collected."""
    df.write.mode(mode).options(**LOSSLESS).csv(path)
