"""Ranked search against scores of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm import odd
from tidemark.llm import lexical_search
from tidemark.llm.common import LOWER, UPPER

LOWERED = str.maketrans(UPPER, LOWER)


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWERED))


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score), for rows of id and text."""
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(doc_id, c) for doc_id, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in set(items):
        scores = []
        for doc_id, c in counts:
            m = 75 + 25 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text)
                if t in c
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(seed, n, words=60):
    r = random.Random(seed)
    pick = lambda: f"w{min(r.randrange(words), r.randrange(words))}"
    return [" ".join(pick() + r.choice(["", ".", ", A-b", "\x00"]) for _ in range(r.choice([0, 1, 5, 30, 200]))) for _ in range(n)]


@pytest.mark.parametrize(("shard_docs", "block_items", "batch"), [(8192, 256, 64), (40, 3, 1), (150, 4, 7)])
def test_equals_scores_of_all(spark, monkeypatch, shard_docs, block_items, batch):
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", block_items)
    monkeypatch.setattr(lexical_search, "BATCH_INTERVALS", batch)
    docs = list(enumerate(corpus(1, 400))) + [(7, t) for t in corpus(2, 5)] + [(1000 + i, "w1 w2 w3") for i in range(60)]
    items = list(enumerate([*corpus(3, 10, 70), "w1 w2 w3 w3", "", None, "unheard of"]))
    found = lexical_search.search(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert got(found) == brute(docs, items)


@pytest.mark.parametrize("seed", range(10))
def test_maxima(seed):
    r = np.random.default_rng(seed)
    n_docs, size = 50, 300
    places = r.choice(20 * n_docs, size, replace=False)
    names, docs, impacts = places // n_docs, places % n_docs, r.integers(1, 1000, size)
    shard = lexical_search.Shard(n_docs, names, docs, impacts)
    starts = r.integers(0, n_docs, 40)
    stops = starts + r.integers(0, n_docs, 40).clip(0, n_docs - starts)
    asked = np.arange(20)
    best, at = shard.maxima(asked, starts, stops)
    for t in asked:
        for i, (start, stop) in enumerate(zip(starts, stops, strict=True)):
            inside = [(int(x), int(d)) for n, d, x in zip(names, docs, impacts, strict=True) if n == t and start <= d < stop]
            assert best[t, i] == max((x for x, _ in inside), default=0)
            assert not inside or (best[t, i], at[t, i]) in inside


def test_an_unfiltered_gate_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "GATE_SLOTS", 2)
    docs, items = list(enumerate(corpus(4, 100))), list(enumerate(corpus(5, 4)))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(lexical_search.search(*frames, k=3)) == brute(docs, items, 3)


def test_long_texts_are_split(monkeypatch):
    text = " ".join(corpus(6, 50))
    whole = lexical_search.term_counts(text)
    monkeypatch.setattr(lexical_search, "SEGMENT", 13)
    assert lexical_search.term_counts(text) == whole and whole[1] == len(terms(text))


def test_odd_input(spark):
    docs = odd.documents(spark)
    items = [(1, "Rain over alpha1"), (1, "Rain over alpha1"), (1, "über2 wörter3 one"), (None, "two words"), (2, None), (3, " ."), (4, odd.prose(2, 80))]
    benchmark = spark.createDataFrame([(*item, "x") for item in items], "item_id long, text string, doc string")
    assert got(lexical_search.search(docs, benchmark)) == brute([(r[0], r[1]) for r in odd.ROWS], items)
    assert lexical_search.search(odd.no_documents(spark), benchmark).collect() == []
    assert lexical_search.search(docs, benchmark.limit(0)).collect() == []
