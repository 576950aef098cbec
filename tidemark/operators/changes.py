"""What an incremental run has to look at again."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sessions import KEY, UNTIMED_BASE, UNTIMED_HEX_DIGITS, stands_alone, timed_summary, unnamed, with_session_cell

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def events_after(events: DataFrame, watermark: datetime | None) -> DataFrame:
    """Events strictly later than the watermark; exact only for feeds that arrive in order."""
    if watermark is None:
        return events
    return events.filter(F.col("event_ts") > F.lit(watermark))


def processed_through(events: DataFrame) -> datetime | None:
    """The watermark a table stands for: its latest event time, null if it has none."""
    micros = events.agg(F.unix_micros(F.max("event_ts"))).first()[0]
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


def in_dates(dates: list[date | None]) -> Column:
    """A filter on the partition column that prunes the scan; null stands for undated rows."""
    known = [d for d in dates if d is not None]
    matches = F.col("event_date").isin(known) if known else F.lit(False)
    return matches | F.col("event_date").isNull() if None in dates else matches


def changed_sessions(fresh: DataFrame, gap_seconds: int) -> DataFrame:
    """The first cell per session key from which fresh events can change session numbers.

    A number depends only on what comes before it, so earlier cells keep theirs.
    """
    return (
        with_session_cell(fresh.filter(~stands_alone()), gap_seconds)
        .groupBy(*KEY)
        .agg(F.min("session_cell").alias("from_cell"))
    )


def _first_timed() -> Column:
    return F.lit(UNTIMED_BASE + 16**UNTIMED_HEX_DIGITS)


def dates_from(cells: DataFrame, changed: DataFrame) -> DataFrame:
    """Dated cells of changed keys whose session numbers can differ."""
    # A new untimed event renumbers everything after it; a timed one leaves untimed events alone.
    reach = F.when(changed["from_cell"] < _first_timed(), F.lit(UNTIMED_BASE)).otherwise(
        changed["from_cell"]
    )
    same_key = [cells[c] == changed[c] for c in KEY]
    return cells.join(changed, [*same_key, cells["session_cell"] >= reach], "left_semi")


def first_changed_session(numbered: DataFrame, changed: DataFrame) -> DataFrame:
    """Per changed key, the first session that can differ: the first one after the change, or the one before if it may go on.

    Cells before the change, and all sessions that end there, keep their numbers. Cells are as wide as the gap, so a session
    can go on into the changed cell from the one before it at most.
    """
    earlier = numbered.join(changed, KEY).filter(F.col("session_cell") < F.col("from_cell"))
    last = earlier.groupBy(*KEY).agg(F.max("session_no").alias("last_no"), F.max("session_cell").alias("last_cell"))
    goes_on = F.col("last_cell") >= F.col("from_cell") - 1
    first = F.when(goes_on, F.col("last_no")).otherwise(F.col("last_no") + 1)
    # A change among untimed events renumbers every session.
    timed = F.when(F.col("from_cell") >= _first_timed(), first)
    return changed.join(last, KEY, "left").select(*KEY, F.coalesce(timed, F.lit(0)).alias("first_no"))


def touched_sessions(numbered: DataFrame, first: DataFrame) -> DataFrame:
    """The timed sessions of some keys from a number on, unnamed."""
    return timed_summary(numbered.join(first, KEY).filter(F.col("session_no") >= F.col("first_no")), unnamed)
