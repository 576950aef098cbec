"""Run a checked query on Spark and in SQL and compare the row multisets."""

from __future__ import annotations

import collections
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str):
    """(rows only in Spark, rows only in SQL, column names of both)."""
    spark_rows = _multiset(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    sql_rows = _multiset(names, result.fetchall())
    return spark_rows - sql_rows, sql_rows - spark_rows, sorted(df.columns), sorted(names)
