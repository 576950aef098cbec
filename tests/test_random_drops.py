"""Random files in random order, run by run, against a rebuild."""

from __future__ import annotations

import os
import random

import pytest

from tests.test_bronze import put
from tests.test_jobs import HEADER, assert_like_rebuilt
from tidemark.plans import run_incremental
from tidemark.sources.layout import Lake

SEEDS = [int(s) for s in os.environ.get("DROP_SEEDS", "1").split(",")]


def line(rng, native):
    day, hour, minute = rng.randint(1, 5), rng.randint(0, 23), rng.choice([0, 10, 29, 30, 31, 59])
    time = rng.choice(["?", ""]) if rng.random() < 0.06 else f"2024-01-0{day} {hour:02}:{minute:02}:00 UTC"
    user = rng.choice(["", *"1234"]) if rng.random() < 0.7 else str(rng.randint(100, 140))
    kind = rng.choice(["view", "purchase", " cart "])
    rest = f"{time},{kind},{rng.randint(1, 6)},{rng.choice(['a.b', ''])},{rng.choice('xyz')},{rng.randint(1, 150)}.5,{user}"
    return f"{rng.randint(1, 90)},{rest}" if native else rest


@pytest.mark.parametrize("native", [False, True])
@pytest.mark.parametrize("seed", SEEDS)
def test_random_drops(spark, tmp_path, seed, native):
    rng = random.Random(seed)
    lake, raw = Lake(str(tmp_path / "lake")), tmp_path / "raw"
    header = f"event_id,{HEADER}" if native else HEADER
    for drop in range(3):
        for part in range(2):
            lines = [line(rng, native) for _ in range(rng.choice([3, 40]))]
            put(raw, f"{rng.random()}-{drop}-{part}.csv", header, *lines)
        run_incremental(spark, str(raw), lake)
        assert_like_rebuilt(spark, lake, str(tmp_path / f"full-{drop}"))
