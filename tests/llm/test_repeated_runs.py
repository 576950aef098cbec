"""Repeated runs of sentences go whole, whatever the lengths of their sentences."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import MEDIUM
from tests.llm.brute import runs_of, runs_removed
from tidemark.llm import substring_dedup
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES


def sentence(name: str, n: int) -> str:
    return " ".join(f"{name}{k}" for k in range(n)) + ". "


def test_a_run_that_starts_with_a_long_sentence_goes_whole(spark):
    passage = sentence("long", 45) + sentence("next", 38)
    short = sentence("a", 4) + sentence("b", 15) + sentence("c", 3) + sentence("d", 2)
    rows = [(k, sentence(f"before{k}x", 7) + p + sentence(f"after{k}x", 9)) for k, p in enumerate([passage, passage, short, short])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.text, r.n_removed) for r in substring_dedup.dedup(docs).select("doc.doc_id", "found.*").collect()}
    assert [got[k][1] for k in range(4)] == [0, 2, 0, 4]
    assert got == runs_removed(rows, substring_dedup.sentences_of)


def test_equals_all_runs_on_the_table(spark):
    rows = sorted(map(tuple, table(spark, MEDIUM, "documents").select("doc_id", "text").collect()))
    got = {r.doc_id: (r.text, r.n_removed) for r in QUERIES["op6_substring_dedup"](spark, MEDIUM).collect()}
    assert got == runs_removed(rows, substring_dedup.sentences_of)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=25), st.data())
def test_spans_inside_a_run_cover_it(sizes, data):
    sentences = [sentence(f"s{k}x", n) for k, n in enumerate(sizes)]
    spans = [(i, j) for i, j, _ in substring_dedup.spans_of(sentences)]
    runs = [(i, j) for i, j, _ in runs_of(sentences)]
    assert len(set(spans)) == len(spans) and set(spans) <= set(runs)
    if runs:
        first, after = data.draw(st.sampled_from(runs))
        covered = {k for i, j in spans if first <= i and j <= after for k in range(i, j)}
        assert covered == set(range(first, after))
