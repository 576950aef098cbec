"""One incremental run: unseen files to bronze, then only what they touch in silver and gold.

Every table is published as a whole version with the version of the layer below that it was made from, so a run that broke
off leaves what was there and the next makes it good. What is new in bronze is read from the folders of the writes
since that version; nothing looks through older rows for it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import models, sessions
from tidemark.operators.changes import EPOCH, changed_sessions, dates_from, first_changed_session, touched_sessions
from tidemark.operators.dedupe import EVENT, latest_per_event, merge_latest
from tidemark.operators.ingest import now_utc
from tidemark.operators.standardize import stable_order, with_event_id
from tidemark.plans.gold import fact_rows
from tidemark.plans.session import require_utc
from tidemark.plans.silver import derived_key, gathered, keyed_events, silver_rows, typed_events
from tidemark.plans.together import together
from tidemark.sources.buckets import append_bucketed, read_bucketed
from tidemark.sources.files import delete_folder, path_exists
from tidemark.sources.layout import Lake
from tidemark.sources.scratch import staging_folder, stored
from tidemark.sources.tables import (
    COMPRESSION,
    DATE_COLUMN,
    UNDATED,
    Version,
    by_date,
    note,
    read_added,
    read_table,
    replace_dates,
    version_of,
    write_table,
)
from tidemark.sources.versions import latest, publish_next
from tidemark.streaming.ingest import ingest_new_files

#: The note of a version that names the version it was made from.
MADE_FROM = "made_from"
ID_DATES = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("part", T.StringType())])
#: Buckets of the dates of native ids: a task of the join with new ids looks at one.
ID_BUCKETS = 64


def done_through(spark: SparkSession, lake: Lake, layer: str, gap_seconds: int | None = None) -> int | None:
    """The version of the layer below that a layer has taken in; null if it has to be made from the start."""
    if layer == "silver":
        version = version_of(spark, lake.silver)
        return version.notes.get(MADE_FROM) if version else None
    done = _gold_done(spark, lake)
    return done["silver"] if done and done["gap_seconds"] == gap_seconds else None


def _parts_of(rows: DataFrame) -> set[str]:
    """Names of the date partitions of some rows, which the driver lists anyway to read a table."""
    names = rows.select(F.coalesce(F.col(DATE_COLUMN).cast("string"), F.lit(UNDATED)).alias("part"))
    return {row.part for row in names.distinct().collect()}


def _parts_of_ids(spark: SparkSession, lake: Lake, ids: DataFrame) -> set[str]:
    """Where copies of events may lie, found by a join that moves the new ids only."""
    return {row.part for row in dates_of_ids(spark, lake, ids).select("part").distinct().collect()}


def dates_of_ids(spark: SparkSession, lake: Lake, ids: DataFrame) -> DataFrame:
    known = read_bucketed(spark, lake.id_dates, ID_DATES, "event_id", ID_BUCKETS)
    return known.join(ids, "event_id", "left_semi")


def _note_ids(spark: SparkSession, lake: Lake) -> None:
    """Bring the dates of native ids up to silver. They may say too much, as after a crash, and never too little."""
    silver, progress = version_of(spark, lake.silver), f"{lake.id_dates}_progress"
    done = latest(spark, progress)
    changed = silver.changed_parts(done[1]["silver"] if done else None)
    if changed is None or changed:
        rows = read_table(spark, lake.silver, parts=changed).select(
            "event_id", F.coalesce(F.col(DATE_COLUMN).cast("string"), F.lit(UNDATED)).alias("part")
        )
        known = read_bucketed(spark, lake.id_dates, ID_DATES, "event_id", ID_BUCKETS)
        append_bucketed(rows.join(known, ["event_id", "part"], "left_anti"), lake.id_dates, "event_id", ID_BUCKETS)
        publish_next(spark, progress, {"silver": silver.number})


def refresh_silver(spark: SparkSession, lake: Lake) -> None:
    """Bring silver up to bronze: new rows take the place of earlier ones of their events."""
    bronze = version_of(spark, lake.bronze)
    if bronze is None:
        return
    since = done_through(spark, lake, "silver")
    native = "event_id" in bronze.schema.names
    if since != bronze.number:
        notes = {MADE_FROM: bronze.number}
        if bronze.changed_parts(since) == set():
            note(spark, lake.silver, notes)  # files were set aside and nothing was added
            return
        added = read_added(spark, lake.bronze, since)
        # A native id that comes later may name events that had a derived one.
        other_ids = since is not None and native and "event_id" not in version_of(spark, lake.silver).notes.get("native", [])
        if added is None or other_ids:
            rows = silver_rows(read_table(spark, lake.bronze))
            write_table(rows, lake.silver, gather=False, notes={**notes, "native": ["event_id"] if native else []})
        else:
            key = derived_key(added)
            typed = typed_events(added) if key else keyed_events(added)
            with staging_folder(spark, "fresh") as folder:
                fresh = stored(latest_per_event(typed, key or EVENT), folder)
                _merge_silver(spark, lake, fresh, key, notes)
    if native:
        _note_ids(spark, lake)


def _merge_silver(spark: SparkSession, lake: Lake, fresh: DataFrame, key: list[str] | None, notes: dict[str, Any]) -> None:
    """Replace the dates that hold the fresh events or an earlier copy of them.

    A derived id holds the time of its event, so its copies share a date; native ids are looked up. Where all ids are derived, the
    fresh rows lack theirs: events are told apart by the ``key``, and ids made where the rows are written.
    """
    event = key or EVENT
    ids = fresh.select(*event)
    if not key:
        _note_ids(spark, lake)  # what a run that broke off has left undone
    parts = _parts_of(fresh) | (set() if key else _parts_of_ids(spark, lake, ids))
    before = read_table(spark, lake.silver, parts=parts)
    for name in set(fresh.columns) - set(before.columns):
        before = before.withColumn(name, F.lit(None).cast(fresh.schema[name].dataType))
    before = before.select(*fresh.columns)
    number = version_of(spark, lake.silver).number + 1
    needed = dict.fromkeys([*event, "user_id", "event_ts", "event_type"])
    same_event = reduce(Column.__and__, (before[name].eqNullSafe(ids[name]) for name in event))
    met = before.join(ids, same_event, "left_semi").select(*needed).unionByName(fresh.select(*needed))
    changes = (with_event_id(met) if key else met).select("event_id", "user_id", "event_ts", "event_type")
    changes.write.mode("overwrite").parquet(lake.silver_changes(number), compression=COMPRESSION)
    rows = gathered(merge_latest(before, fresh, event))
    replace_dates(stable_order(with_event_id(rows) if key else rows), lake.silver, parts, notes, gather=False)


def _gold_done(spark: SparkSession, lake: Lake) -> dict[str, Any] | None:
    done = latest(spark, lake.gold_progress)
    return done[1] if done else None


def note_done(spark: SparkSession, lake: Lake, gap_seconds: int, silver: int, tables: list[str]) -> None:
    """Note which version of silver gold was made from, and the versions of its tables."""
    numbers = {path: version_of(spark, path).number for path in tables}
    publish_next(spark, lake.gold_progress, {"gap_seconds": gap_seconds, "silver": silver, "tables": numbers})


def _changed_rows(spark: SparkSession, lake: Lake, silver: Version, since: int) -> DataFrame | None:
    """Rows that silver has got or lost since a version; null if that is not known."""
    folders = [lake.silver_changes(number) for number, _, _, names in silver.since(since) if names]
    if not all(path_exists(spark, folder) for folder in folders):
        return None
    return spark.read.parquet(*folders)


def _replacing(rows: DataFrame, path: str, parts: set[str], hidden: bool = False, gather: bool = True) -> Callable[[], None]:
    return lambda: replace_dates(rows, path, parts, hidden_date=hidden, gather=gather)


def refresh_gold(spark: SparkSession, lake: Lake, gap_seconds: int) -> None:
    """Bring the gold tables up to silver by way of mergeable parts kept per date."""
    silver = version_of(spark, lake.silver)
    if silver is None:
        return
    state = {
        "customer_days": lambda rows: models.customer_parts(rows, (DATE_COLUMN,)),
        "product_days": lambda rows: models.product_parts(rows, (DATE_COLUMN,)),
        f"cell_days_{gap_seconds}": lambda rows: sessions.session_cells(rows, gap_seconds, (DATE_COLUMN,)),
    }
    numbered = lake.state(f"numbered_days_{gap_seconds}")
    tables = [*(lake.state(name) for name in state), numbered, *(lake.gold_table(n) for n in ("fact_events", "session_summary"))]
    since = done_through(spark, lake, "gold", gap_seconds)
    if since == silver.number:
        return
    parts = silver.changed_parts(since)
    if parts == set() and _tables_as_noted(spark, lake):
        note_done(spark, lake, gap_seconds, silver.number, tables)
        return
    changed = _changed_rows(spark, lake, silver, since) if parts else None
    if changed is not None and _tables_as_noted(spark, lake):
        _merge_gold(spark, lake, gap_seconds, state, numbered, parts, changed)
    else:
        _make_gold(spark, lake, gap_seconds, state, numbered)
    note_done(spark, lake, gap_seconds, silver.number, tables)
    for number in range((since or 0) + 1, silver.number + 1):
        delete_folder(spark, lake.silver_changes(number))


def _tables_as_noted(spark: SparkSession, lake: Lake) -> bool:
    """Whether the tables are those of the last run: one that broke off, or another job, may have written some."""
    noted = _gold_done(spark, lake)["tables"]
    versions = {path: version_of(spark, path) for path in noted}
    return all(version and version.number == noted[path] for path, version in versions.items())


State = dict[str, Callable[[DataFrame], DataFrame]]


def _start_dated(summary: DataFrame) -> DataFrame:
    return summary.withColumn(DATE_COLUMN, F.to_date("start_ts"))


def _summary_rows(sessions_found: DataFrame) -> DataFrame:
    """Rows of the summary gathered by date, to be written as they are; ids are made where they are written."""
    return sessions.name_summary(by_date(_start_dated(sessions_found)))


def _merge_dimensions(spark: SparkSession, lake: Lake) -> list[Callable[[], Any]]:
    customers, products = (read_table(spark, lake.state(name)) for name in ("customer_days", "product_days"))
    return [
        lambda: write_table(models.merge_customers(customers), lake.gold_table("dim_customer")),
        lambda: write_table(models.merge_products(products), lake.gold_table("dim_product")),
    ]


def _make_gold(spark: SparkSession, lake: Lake, gap_seconds: int, state: State, numbered: str) -> None:
    silver = read_table(spark, lake.silver)
    together(spark, *(lambda rows=make(silver), name=name: write_table(rows, lake.state(name)) for name, make in state.items()))
    cells = read_table(spark, lake.state(f"cell_days_{gap_seconds}"))
    together(
        spark,
        lambda: write_table(sessions.number_sessions(cells, gap_seconds), numbered),
        *_merge_dimensions(spark, lake),
    )
    index = read_table(spark, numbered)
    facts = fact_rows(silver, sessions.one_number_per_cell(index), gap_seconds)
    summary = _summary_rows(sessions.summarize_sessions(silver, index, gap_seconds, sessions.unnamed))
    together(
        spark,
        lambda: write_table(facts, lake.gold_table("fact_events"), gather=False),
        lambda: write_table(summary, lake.gold_table("session_summary"), gather=False, hidden_date=True),
    )


def _merge_gold(
    spark: SparkSession, lake: Lake, gap_seconds: int, state: State, numbered: str, parts: set[str], changed: DataFrame
) -> None:
    """Sessions are numbered anew for users with changed events only, and rewritten from the first that can differ."""
    touched = read_table(spark, lake.silver, parts=parts)
    together(spark, *(_replacing(make(touched), lake.state(name), parts) for name, make in state.items()))
    cells = read_table(spark, lake.state(f"cell_days_{gap_seconds}"))
    with (
        staging_folder(spark, "changed") as a,
        staging_folder(spark, "renumbered") as b,
        staging_folder(spark, "old") as c,
        staging_folder(spark, "now") as d,
    ):
        keys = stored(changed_sessions(changed, gap_seconds), a)
        history = cells.join(keys.select(*sessions.KEY), sessions.KEY, "left_semi")
        renumbered = stored(sessions.number_sessions(history, gap_seconds), b)
        fact_parts = parts | _parts_of(dates_from(renumbered, keys))

        first = first_changed_session(renumbered, keys)
        sessions_now = stored(touched_sessions(renumbered, first), d)
        old = read_table(spark, numbered).join(keys.select(*sessions.KEY), sessions.KEY, "left_semi")
        sessions_before = stored(touched_sessions(old, first), c)
        # Events that stand alone: those that went or came, and as they are now.
        alone = sessions.alone_summary(changed, sessions.unnamed)
        moved_ids = changed.select("event_id").distinct()
        still = touched.join(moved_ids, "event_id", "left_semi")
        alone_now = sessions.alone_summary(still, sessions.unnamed).filter("start_ts IS NOT NULL")
        start_parts = _parts_of(_start_dated(sessions_now.unionByName(sessions_before).unionByName(alone)))
        # Untimed events are sessions of their own, which the date they lack holds together.
        start_parts = (start_parts - {UNDATED}) | (parts & {UNDATED})
        # A session that is there now was there before or is new, so those before are all that can be in the table.
        gone = sessions.name_summary(sessions_before.unionByName(alone)).select(F.unhex("session_id").alias("packed_id"))
        before = read_table(spark, lake.gold_table("session_summary"), parts=start_parts - {UNDATED})
        packed = before.withColumn("packed_id", F.unhex("session_id")).drop("session_id")
        kept = packed.join(gone.distinct(), "packed_id", "left_anti")
        summary = kept.unionByName(sessions_now.unionByName(alone_now), allowMissingColumns=True)
        if UNDATED in start_parts:
            undated = read_table(spark, lake.silver, parts=[UNDATED])
            untimed = sessions.untimed_summary(undated, gap_seconds, sessions.unnamed)
            untimed = untimed.unionByName(sessions.alone_summary(undated, sessions.unnamed))
            summary = summary.unionByName(untimed, allowMissingColumns=True)

        same = read_table(spark, numbered, parts=fact_parts).join(keys.select(*sessions.KEY), sessions.KEY, "left_anti")
        moved = renumbered.filter(_in_parts(fact_parts)).select(*same.columns)
        together(
            spark,
            _replacing(same.unionByName(moved), numbered, fact_parts),
            _replacing(_summary_rows(summary), lake.gold_table("session_summary"), start_parts, hidden=True, gather=False),
            *_merge_dimensions(spark, lake),
        )
    numbers = sessions.one_number_per_cell(read_table(spark, numbered, parts=fact_parts))
    facts = fact_rows(read_table(spark, lake.silver, parts=fact_parts), numbers, gap_seconds)
    replace_dates(facts, lake.gold_table("fact_events"), fact_parts, gather=False)


def _in_parts(parts: set[str]):
    return F.coalesce(F.col(DATE_COLUMN).cast("string"), F.lit(UNDATED)).isin(sorted(parts))


def run_incremental(
    spark: SparkSession,
    raw_dir: str,
    lake: Lake,
    pattern: str = "*.csv",
    session_gap_minutes: int = 30,
    schema: T.StructType | None = None,
    files_per_batch: int | None = None,
    skip_corrupt: bool = False,
    widen: bool = False,
) -> None:
    """Ingest unseen files and refresh silver and gold; with nothing new, nothing is rewritten.

    ``files_per_batch`` bounds what one step of the stream takes in, as for a first load of a large lake. ``widen`` adds
    the columns of files that have more; otherwise such files are set aside.
    """
    require_utc(spark)
    bronze = version_of(spark, lake.bronze)
    last = (bronze.notes if bronze else {}).get("through")
    instant = now_utc()
    if last is not None:
        instant = max(instant, EPOCH + timedelta(microseconds=last + 1))
    ingest_new_files(
        spark, raw_dir, lake.bronze, lake.ingest_checkpoint, pattern, schema, instant, files_per_batch, skip_corrupt, widen
    )
    refresh_silver(spark, lake)
    refresh_gold(spark, lake, sessions.gap_from_minutes(session_gap_minutes))
