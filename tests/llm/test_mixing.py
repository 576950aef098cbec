from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import MEDIUM
from tidemark.llm import mixing
from tidemark.llm.common import table


def rake_by_numpy(cells, targets, total):
    """The same sweeps over an array of source, language and topic."""
    axes = {m: sorted({c[m] for c in cells}) for m in mixing.MARGINS}
    cube = np.zeros([len(axes[m]) for m in mixing.MARGINS])
    for c in cells:
        cube[tuple(axes[m].index(c[m]) for m in mixing.MARGINS)] = c.tokens
    want = []
    for k, margin in enumerate(mixing.MARGINS):
        natural = cube.sum(axis=tuple(i for i in range(3) if i != k))
        share = np.where(natural > 0, natural ** targets[margin], 0)
        want.append(share / share.sum() * total)
    for _ in range(mixing.SWEEPS):
        for k in range(3):
            others = tuple(i for i in range(3) if i != k)
            now = cube.sum(axis=others)
            shape = [-1 if i == k else 1 for i in range(3)]
            cube = cube * np.divide(want[k], now, out=np.zeros_like(now), where=now > 0).reshape(shape)
    return {tuple(c[m] for m in mixing.MARGINS): cube[tuple(axes[m].index(c[m]) for m in mixing.MARGINS)] for c in cells}


def test_raking_and_rate(spark):
    docs = table(spark, MEDIUM, "documents")
    targets, fraction = {"source": 0.5, "lang": 0.3, "topic": 1.0}, 0.6
    rows = mixing.probabilities(docs, targets, fraction).collect()
    total = sum(r.tokens for r in rows)
    want = rake_by_numpy(rows, targets, total)
    for r in rows:
        assert abs(r.mass - want[tuple(r[m] for m in mixing.MARGINS)]) <= 1e-6 * total
    # The expected tokens are the budget, and what the weights leave of the targets is exact.
    assert abs(sum(r.tokens * r.probability for r in rows) - fraction * total) < 1e-6 * total
    shares = {}
    for r in rows:
        shares[r.source] = shares.get(r.source, 0) + r.tokens * r.probability * r.left_over
    scale = sum(shares.values())
    natural = {}
    for r in rows:
        natural[r.source] = natural.get(r.source, 0) + r.tokens
    target = {s: t**0.5 for s, t in natural.items()}
    for s in shares:
        assert abs(shares[s] / scale - target[s] / sum(target.values())) < 1e-9


def test_named_weights(spark):
    docs = table(spark, MEDIUM, "documents")
    rows = mixing.probabilities(docs, {"lang": {"en": 3.0, "de": 1.0}, "source": 1.0}, 0.3).collect()
    mass = {}
    for r in rows:
        mass[r.lang] = mass.get(r.lang, 0) + r.mass
    assert abs(mass["en"] / mass["de"] - 3) < 0.05
    assert mass["fr"] > 0


def test_sample_is_the_same_for_any_partitioning(spark):
    docs = table(spark, MEDIUM, "documents")
    targets = {"source": 0.5, "lang": 0.7}
    one = mixing.sample(docs, targets, 0.5)
    other = mixing.sample(docs.repartition(7), targets, 0.5)
    assert {r.doc_id for r in one.collect()} == {r.doc_id for r in other.collect()}
    got = one.agg(F.sum("mix_tokens")).first()[0] / mixing.cells_of(docs).agg(F.sum("tokens")).first()[0]
    assert abs(got - 0.5) < 0.06
