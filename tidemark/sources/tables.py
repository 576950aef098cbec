"""Lake tables: parquet in folders of their own per write, and a published list of those that count.

Each write goes to a new folder, partitioned by ``event_date`` if the rows have one. Only when it is complete, a
version of the table is published that says which folders hold which dates, with the columns of the table and what was written
lately. So a write that breaks off changes nothing, a reader sees a table before or after a write, and what was added since
a version can be read by itself. Folders that a version no longer names stay until the next one, for readers under way.

Read such tables by ``read_table``; a plain parquet scan of the folder would see more than one version.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable
from dataclasses import dataclass, field
from datetime import date
from typing import Any
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import delete_folder, names_in, path_exists
from tidemark.sources.versions import latest, publish

DATE_COLUMN = "event_date"
#: The folder of versions, which scans pass over, and the partition column of writes.
VERSIONS, WRITE = "_versions", "_write"
#: Writes that a version lists; whoever has not looked for longer takes the whole table.
LISTED_CHANGES = 500
UNDATED = "__HIVE_DEFAULT_PARTITION__"
#: Ids are hashes spelled in hexadecimal digits, which this codec halves and Spark's default doesn't.
COMPRESSION = "zstd"
#: The one part of a table without dates.
WHOLE = ""


@dataclass
class Version:
    """What a table holds. Parts are named by their date, as in partition folders."""

    number: int
    schema: T.StructType
    dated: bool
    #: Writes that hold rows of a part, by part.
    parts: dict[str, list[str]]
    #: All parts that a write made, whether they still count or not.
    made: dict[str, list[str]]
    #: Of late: the number of a version, whether its write was appended or took the place of its parts, and the parts.
    changes: list[tuple[int, str, bool, list[str]]]
    #: Folders that the version before named and this one doesn't.
    retired: list[str] = field(default_factory=list)
    #: Whatever the writer noted with the version.
    notes: dict[str, Any] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {_folder(write, name) for name, writes in self.parts.items() for write in writes}

    def since(self, number: int | None) -> list[tuple[int, str, bool, list[str]]] | None:
        """The changes after a version; null if they are no longer known."""
        if number is None or number > self.number:
            return None
        later = [change for change in self.changes if change[0] > number]
        return later if len(later) == self.number - number else None

    def changed_parts(self, number: int | None) -> set[str] | None:
        changes = self.since(number)
        return None if changes is None else {name for *_, names in changes for name in names}


def part_name(day: date | str | None) -> str:
    return UNDATED if day is None else day if isinstance(day, str) else day.isoformat()


def _folder(write: str, name: str) -> str:
    return f"{WRITE}={write}" if name == WHOLE else f"{WRITE}={write}/{DATE_COLUMN}={name}"


def version_of(spark: SparkSession, path: str) -> Version | None:
    found = latest(spark, f"{path}/{VERSIONS}")
    if found is None:
        return None
    number, state = found
    changes = [(n, write, added, names) for n, write, added, names in state["changes"]]
    schema = T.StructType.fromJson(state["schema"])
    return Version(
        number, schema, state["dated"], state["parts"], state["made"], changes, state["retired"], state["notes"]
    )


def kept_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns kept with a table, null if it was written by something else."""
    version = version_of(spark, path)
    return version.schema if version else None


def _publish(spark: SparkSession, path: str, version: Version, before: Version | None) -> None:
    version.retired = sorted((before.folders() if before else set()) - version.folders())
    state = {
        "schema": version.schema.jsonValue(),
        "dated": version.dated,
        "parts": version.parts,
        "made": version.made,
        "changes": version.changes[-LISTED_CHANGES:],
        "retired": version.retired,
        "notes": version.notes,
    }
    publish(spark, f"{path}/{VERSIONS}", version.number, state)
    # What went out of use with the version before, and folders of writes that broke off.
    for folder in before.retired if before else ():
        if folder not in version.folders():
            delete_folder(spark, f"{path}/{folder}")
    in_use = {folder.split("/")[0] for folder in (*version.folders(), *version.retired)}
    for name in names_in(spark, path):
        if name.startswith(f"{WRITE}=") and name not in in_use:
            delete_folder(spark, f"{path}/{name}")


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    skip_corrupt: bool = False,
    parts: Iterable[date | str | None] | None = None,
) -> DataFrame:
    """Scan a table, or the given parts of it, by the columns kept with it.

    ``skip_corrupt`` silently leaves out files that cannot be read. A folder that holds no version is read as plain parquet.
    """
    version = version_of(spark, path)
    reader = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower())
    if version is None:
        return _read_plain(spark, reader, path, schema)
    wanted = None if parts is None else {part_name(part) for part in parts}
    live = {name: writes for name, writes in version.parts.items() if wanted is None or name in wanted}
    return _scan(spark, reader, path, version, live, schema)


def _read_plain(spark: SparkSession, reader: Any, path: str, schema: T.StructType | None) -> DataFrame:
    try:
        return (reader if schema is None else reader.schema(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no table at {path}") from error
        raise


def _scan(
    spark: SparkSession,
    reader: Any,
    path: str,
    version: Version,
    live: dict[str, list[str]],
    schema: T.StructType | None = None,
) -> DataFrame:
    schema = schema or version.schema
    by_write: dict[str, list[str]] = {}
    for name, writes in live.items():
        for write in writes:
            by_write.setdefault(write, []).append(name)
    folders = []
    for write, names in by_write.items():
        # One folder instead of its dates, if they all count.
        whole = len(names) == len(version.made[write])
        folders += [_folder(write, WHOLE)] if whole else [_folder(write, name) for name in names]
    if not folders:
        return spark.createDataFrame([], schema)
    found = {f.name for f in schema.fields}
    beside = [T.StructField(WRITE, T.StringType())]
    if version.dated and DATE_COLUMN not in found:
        beside.append(T.StructField(DATE_COLUMN, T.DateType()))
    rows = (
        reader.schema(T.StructType([*schema.fields, *beside]))
        .option("basePath", path)
        .parquet(*(f"{path}/{folder}" for folder in folders))
    )
    return rows.select(*(F.col(f"`{f.name}`") for f in schema.fields))


def read_added(spark: SparkSession, path: str, since: int | None) -> DataFrame | None:
    """Rows that were appended after a version, from the folders of these writes alone; null if that is not known."""
    version = version_of(spark, path)
    changes = version.since(since) if version else None
    if changes is None or not all(added for _, _, added, _ in changes):
        return None
    live: dict[str, list[str]] = {}
    for _, write, _, names in changes:
        for name in names:
            live.setdefault(name, []).append(write)
    return _scan(spark, spark.read, path, version, live)


def _columns_after(path: str, kept: T.StructType | None, new: T.StructType, widen: bool) -> T.StructType:
    """The columns of a table that gets rows of other columns: refused, or widened if asked for."""
    if kept is None:
        return new
    types = {f.name: f.dataType for f in kept.fields}
    if changed := [f.name for f in new.fields if types.get(f.name, f.dataType) != f.dataType]:
        raise ValueError(f"{path} holds other types in {changed}")
    added = [f for f in new.fields if f.name not in types]
    if added and not widen:
        raise ValueError(f"{path} has no {[f.name for f in added]}; widen the table to add them")
    return T.StructType([*kept.fields, *added])


def by_date(df: DataFrame) -> DataFrame:
    """Gather rows of a date before a partitioned write.

    Without it every task opens a file per date it holds. ``rebalance`` lets adaptive execution
    split a date that is too large for a task and merge small ones.
    """
    return df.hint("rebalance", DATE_COLUMN)


def _write(df: DataFrame, path: str, number: int, gather: bool) -> tuple[str, list[str], int]:
    """Write rows to a folder of their own: its name, the parts that it has, and the number of rows.

    Rows are counted in the writing tasks, which Spark counts once even if a task is run again.
    """
    write, dated, counted = f"{number:08d}-{uuid4().hex[:8]}", DATE_COLUMN in df.columns, Observation()
    rows = by_date(df) if dated and gather else df
    writer = rows.observe(counted, F.count(F.lit(1)).alias("rows")).write
    folder = f"{path}/{_folder(write, WHOLE)}"
    (writer.partitionBy(DATE_COLUMN) if dated else writer).parquet(folder, compression=COMPRESSION)
    prefix = f"{DATE_COLUMN}="
    names = [n.removeprefix(prefix) for n in names_in(df.sparkSession, folder) if n.startswith(prefix)] if dated else [WHOLE]
    return write, names, counted.get.get("rows", 0)


def _kept(df: DataFrame, hidden_date: bool) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if not (hidden_date and f.name == DATE_COLUMN)])


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    gather: bool = True,
    widen: bool = False,
    notes: dict[str, Any] | None = None,
    hidden_date: bool = False,
) -> int:
    """Write a table, partitioned by ``event_date`` if it has one, and return the number of rows written.

    Appended rows may lack some of the table's columns, but have others only with ``widen``; earlier rows are null
    there. ``notes`` are published with the rows, and earlier ones of other names kept. With ``hidden_date`` the date
    divides the table and is none of its columns.
    """
    spark = df.sparkSession
    before = version_of(spark, path)
    if before is None and mode == "append" and path_exists(spark, path) and names_in(spark, path):
        raise ValueError(f"{path} holds files that are no version of a table, so nothing can be appended")
    append = before is not None and mode == "append"
    schema = _columns_after(path, before.schema, _kept(df, hidden_date), widen) if append else _kept(df, hidden_date)
    number = before.number + 1 if before else 1
    if append and before.dated != (DATE_COLUMN in df.columns):
        raise ValueError(f"{path} is {'' if before.dated else 'not '}divided by {DATE_COLUMN}")
    write, names, rows = _write(df, path, number, gather)
    parts = {name: list(writes) for name, writes in before.parts.items()} if append else {}
    for name in names:
        parts.setdefault(name, []).append(write)
    made = {**(before.made if append else {}), write: names}
    changes = [*before.changes, (number, write, True, names)] if append else []
    noted = {**(before.notes if before else {}), **(notes or {})}
    _publish(spark, path, Version(number, schema, DATE_COLUMN in df.columns, parts, made, changes, [], noted), before)
    return rows


def replace_dates(
    df: DataFrame,
    path: str,
    dates: Collection[date | str | None],
    notes: dict[str, Any] | None = None,
    hidden_date: bool = False,
    gather: bool = True,
) -> None:
    """Make ``df`` the content of the given dates of a table, all at once; others stay untouched.

    ``df`` may read the table itself, whose present folders stay until the next write.
    """
    spark = df.sparkSession
    before = version_of(spark, path)
    number = before.number + 1 if before else 1
    write, names, _ = _write(df, path, number, gather)
    replaced = {part_name(day) for day in dates}
    if stray := set(names) - replaced:
        raise ValueError(f"rows of {sorted(stray)} are not of the dates to replace")
    parts = {name: writes for name, writes in (before.parts if before else {}).items() if name not in replaced}
    parts |= {name: [write] for name in names}
    used = {write for writes in parts.values() for write in writes}
    made = {w: made for w, made in ({**(before.made if before else {}), write: names}).items() if w in used}
    changes = [*(before.changes if before else []), (number, write, False, sorted(replaced))]
    noted = {**(before.notes if before else {}), **(notes or {})}
    schema = _columns_after(path, before.schema if before else None, _kept(df, hidden_date), True)
    _publish(spark, path, Version(number, schema, True, parts, made, changes, [], noted), before)


def note(spark: SparkSession, path: str, notes: dict[str, Any]) -> None:
    """Publish notes with an unchanged table."""
    before = version_of(spark, path)
    state = {**before.notes, **notes}
    changes = [*before.changes, (before.number + 1, "", True, [])]
    _publish(spark, path, Version(before.number + 1, before.schema, before.dated, before.parts, before.made, changes, [], state), before)
