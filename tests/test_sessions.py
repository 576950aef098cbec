from __future__ import annotations

import hashlib
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.queries import keyed_shop, summary_by_id
from tests.conftest import MEDIUM
from tidemark.operators import sessions
from tidemark.sources.scratch import stage

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
DECLARED = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
    ]
)


def at(seconds: float) -> datetime:
    return START + timedelta(microseconds=round(seconds * 1_000_000))


def events(spark, rows, parts=3):
    return spark.createDataFrame([r if len(r) == 4 else (*r, "view") for r in rows], DECLARED).repartition(
        parts
    )


def by_hand(rows, gap):
    """Session id per event id, by walking each key's events in order."""
    keys = {}
    for event_id, user, ts, *_ in rows:
        keys.setdefault(str(user) if user is not None else event_id, []).append((ts, event_id))
    found = {}
    for key, members in keys.items():
        untimed = [m for m in members if m[0] is None]
        timed = sorted((m for m in members if m[0] is not None), key=lambda m: m[0])
        untimed.sort(key=lambda m: (hashlib.md5((m[1] or "").encode()).hexdigest(), m[1] or ""))
        number, before = 0, None
        for ts, event_id in untimed + timed:
            second = None if ts is None else int((ts - START).total_seconds() // 1)
            if before is None or second is None or second - before > gap:
                number += 1
            before = second
            text = str(number) if key is None else f"{key}||{number}"
            found[event_id] = hashlib.sha256(text.encode()).hexdigest()
    return found


def found_by_spark(spark, rows, gap):
    out = sessions.with_session_id(events(spark, rows), gap).collect()
    assert len(out) == len(rows)
    return {r["event_id"]: r["session_id"] for r in out}


def test_gap_is_counted_in_whole_seconds(spark):
    rows = [
        ("a1", 1, at(0)),
        ("a2", 1, at(1800)),
        ("b1", 2, at(0)),
        ("b2", 2, at(1801)),
        ("c1", 3, at(10.1)),
        ("c2", 3, at(1810.9)),
        ("d1", 4, at(10.9)),
        ("d2", 4, at(1811.0)),
    ]
    got = found_by_spark(spark, rows, 1800)
    assert got == by_hand(rows, 1800)
    same = {p: got[f"{p}1"] == got[f"{p}2"] for p in "abcd"}
    assert same == {"a": True, "b": False, "c": True, "d": False}


def test_untimed_events_come_first_and_stand_alone(spark):
    rows = [
        ("n1", 1, None),
        ("n2", 1, None),
        ("t1", 1, at(0)),
        ("t2", 1, at(1800)),
        ("t3", 1, at(3601)),
    ]
    got = found_by_spark(spark, rows, 1800)
    number = {hashlib.sha256(f"1||{n}".encode()).hexdigest(): n for n in range(1, 6)}
    assert sorted([number[got["n1"]], number[got["n2"]]]) == [1, 2]
    assert [number[got[e]] for e in ("t1", "t2", "t3")] == [3, 3, 4]


def test_events_without_user_stand_for_themselves(spark):
    rows = [("x", None, at(0)), ("y", None, at(1)), ("z", None, None), (None, None, at(5))]
    got = found_by_spark(spark, rows, 1800)
    assert got == by_hand(rows, 1800)
    assert len(set(got.values())) == 4


def test_a_native_number_meets_the_user_of_that_number(spark):
    rows = [("5", None, at(0)), ("e1", 5, at(10)), ("05", None, at(10)), ("e2", 5, at(4000))]
    got = found_by_spark(spark, rows, 1800)
    assert got == by_hand(rows, 1800)
    assert got["5"] == got["e1"] and got["05"] != got["e1"]


@pytest.mark.parametrize(("minutes", "seconds"), [(30, 1800), (60, 3600), (0, 1), (-5, 1)])
def test_gap_argument(minutes, seconds):
    assert sessions.gap_from_minutes(minutes) == seconds


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("gap", [1, 60, 1800])
def test_random_events_against_a_walk(spark, seed, gap):
    rng = random.Random(seed * 1000 + gap)
    rows = []
    for i in range(400):
        user = rng.choice([None, 1, 2, 3, 40, 41])
        ts = None if rng.random() < 0.1 else at(rng.choice([gap, gap * 40]) * rng.random() * rng.randint(1, 9))
        native = rng.random() < 0.1
        rows.append((str(i) if native else f"id-{i}", user, ts, rng.choice(["view", "buy"])))
    # Ordinals of untimed events of a key shared by users and bare ids may differ: no such rows.
    rows = [r for r in rows if not (r[2] is None and (r[0] in {"1", "2", "3", "40", "41"}))]
    assert found_by_spark(spark, rows, gap) == by_hand(rows, gap)

    df = events(spark, rows)
    direct = sessions.summarize_sessions(df, sessions.session_index(df, gap), gap)
    by_id = summary_by_id(sessions.with_session_id(df, gap))
    assert direct.exceptAll(by_id).isEmpty() and by_id.exceptAll(direct).isEmpty()


def test_a_user_with_a_third_of_all_rows(spark):
    """The hot user's events are spread over cells; the index holds a row per cell, not per event."""
    df = spark.range(60_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000 + 100).cast("bigint").alias("user_id"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") * 37) % 200_000).alias("event_ts"),
        F.lit("view").alias("event_type"),
    )
    cells = sessions.session_cells(df, 1800)
    assert cells.filter("key_number = 7").count() <= 200_000 // 1800 + 2
    out = sessions.with_session_id(df)
    assert out.count() == 60_000
    spread = out.filter("user_id = 7").select("session_id").distinct().count()
    assert spread == 1


def test_same_sessions_as_sparks_own_session_window(spark):
    df = keyed_shop(spark, MEDIUM)
    ours = sessions.with_session_id(df).select("session_id").distinct().count()
    theirs = (
        df.groupBy(F.session_window(F.date_trunc("second", "event_ts"), "1800 seconds"), "user_id")
        .count()
        .count()
    )
    assert ours == theirs


def test_numbers_do_not_depend_on_the_blocks(spark, monkeypatch):
    """Blocks of two cells, of sixteen, and all cells in one."""
    r = random.Random(11)
    rows, start = [], 1_704_067_200
    for user in (1, 2, 3):
        at = start + r.randrange(100)
        for _ in range(150):
            at += r.choice([0, 1, 2, 3, 9, 40])
            rows.append((f"{user}-{len(rows)}", user if r.random() < 0.9 else None, at))
    rows += [(f"u{k}", 1, None) for k in range(5)]
    events = spark.createDataFrame(rows, "event_id string, user_id bigint, t bigint").selectExpr(
        "event_id", "user_id", "timestamp_seconds(t) AS event_ts", "'view' AS event_type"
    )
    events = stage(events, "blocks")
    seen = []
    for bits in (1, 4, 40):
        monkeypatch.setattr(sessions, "BLOCK_BITS", bits)
        found = sessions.with_session_id(events, gap_seconds=3)
        seen.append(sorted(tuple(map(str, row)) for row in found.select("event_id", "session_id").collect()))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == len(rows)
