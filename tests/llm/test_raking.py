"""Raking goes on until the marginals are at their targets, or says that they cannot be reached."""

from __future__ import annotations

import warnings

import pytest

from tidemark.llm import mixing
from tidemark.llm.queries import MIX_TARGETS


def raked(spark, table, targets):
    rows = [(f"s{i}", f"l{j}", "prose", n, 1) for i, row in enumerate(table) for j, n in enumerate(row) if n]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long, documents long")
    return mixing.rake(mixing.with_targets(cells, targets, sum(r[3] for r in rows))).collect()


def test_marginals_where_sources_nearly_determine_languages(spark):
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        rows = raked(spark, [(3_000_000, 1), (1, 50_000), (200_000, 10)], MIX_TARGETS)
    for margin in mixing.MARGINS:
        mass, natural = {}, {}
        for r in rows:
            mass[r[margin]] = mass.get(r[margin], 0) + r.mass
            natural[r[margin]] = natural.get(r[margin], 0) + r.tokens
        powers = {v: n ** MIX_TARGETS[margin] for v, n in natural.items()}
        for v in mass:
            want = powers[v] / sum(powers.values())
            assert abs(mass[v] / sum(mass.values()) - want) < 1e-5 * want


def test_infeasible_targets_are_named(spark):
    with pytest.warns(UserWarning, match="not reached.*lang 'l1'"):
        rows = raked(spark, [(1000, 0), (0, 1000)], {"source": 1.0, "lang": {"l0": 9.0, "l1": 1.0}})
    assert sorted(round(r.mass) for r in rows) == [1000, 1000]
