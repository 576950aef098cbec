from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import MEDIUM
from tests.llm import brute
from tidemark.llm import line_dedup, ngram_join, substring_dedup
from tidemark.llm.common import table
from tidemark.llm.components import roots
from tidemark.llm.count_tree import CountTree, banded_links, count_vector, groups_for
from tidemark.llm.queries import QUERIES
from tidemark.llm.shingles import least_overlap, overlap


def rows_of(spark, sf_dir):
    return sorted(map(tuple, table(spark, sf_dir, "documents").select("doc_id", "text").collect()))


def test_ngram_join_equals_brute_force(spark):
    got = sorted(map(tuple, QUERIES["op5_ngram_jaccard_join"](spark, MEDIUM).collect()), key=str)
    assert got == brute.components(rows_of(spark, MEDIUM))


def near_copies(n: int) -> list[tuple[int, str]]:
    """Chains of texts that differ in a word more each, and a passage that all share."""
    shared = " ".join(f"shared{k}" for k in range(30))
    rows = []
    for doc_id in range(n):
        chain, step = doc_id % 7, doc_id // 7
        words = [f"c{chain}w{k}" if k >= 2 * step else f"d{doc_id}w{k}" for k in range(90)]
        rows.append((doc_id, " ".join(words) + " " + shared))
    return rows


def test_small_pages_lose_no_link(spark):
    rows = near_copies(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.components(rows)
    assert len({c for _, _, c in want}) < 150
    for page in (150, 700, 10**6):
        assert sorted(map(tuple, ngram_join.components(docs, page).collect()), key=str) == want


def test_keep_one_keeps_the_smallest_of_each_group(spark):
    rows = near_copies(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in ngram_join.keep_one(docs).collect()}
    assert kept == {c for _, _, c in brute.components(rows)}


sets = st.lists(st.sets(st.integers(0, 60), min_size=1, max_size=40), min_size=1, max_size=60)


@settings(max_examples=150, deadline=None)
@given(sets)
def test_tree_lets_every_link_through(drawn):
    arrays = [np.array(sorted(s), dtype=np.uint64) for s in drawn]
    sizes = np.array([len(a) for a in arrays])
    groups = groups_for(8)
    vectors = np.stack([count_vector(a, groups) for a in arrays])
    tree = CountTree(vectors, sizes)
    for i, a in enumerate(arrays):
        found = set(tree.search(vectors[i], int(sizes[i])).tolist())
        for j, b in enumerate(arrays):
            if overlap(a, b) >= least_overlap(len(a), len(b)):
                assert j in found


def classes_of(links, n):
    lowest = list(range(n))
    for _ in range(n):
        for a, b in links:
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    return lowest


@settings(max_examples=150, deadline=None)
@given(sets, st.data())
def test_bands_span_the_same_classes(drawn, data):
    arrays = [np.array(sorted(s), dtype=np.uint64) for s in drawn]
    n = len(arrays)
    linked = [
        (i, j) for i in range(n) for j in range(i) if overlap(arrays[i], arrays[j]) >= least_overlap(len(arrays[i]), len(arrays[j]))
    ]
    first = data.draw(st.integers(0, n - 1))
    links = list(banded_links(arrays, overlap, first, np.ones(n, dtype=bool)))
    assert classes_of(links, n) == classes_of(linked, n) and len(links) < n
    # Some search all, the others have met before.
    visiting = np.array(data.draw(st.lists(st.booleans(), min_size=n, max_size=n)))
    met = [(i, j) for i, j in linked if not visiting[i] and not visiting[j]]
    found = list(banded_links(arrays, overlap, first, visiting))
    assert classes_of(met + found, n) == classes_of(linked, n)


def test_a_large_set_among_many_small_ones_takes_little_memory():
    import tracemalloc

    arrays = [np.arange(20_000, dtype=np.uint64), *(np.arange(5, dtype=np.uint64) + np.uint64(100 * k) for k in range(1500))]
    tracemalloc.start()
    assert list(banded_links(arrays, overlap, 0, np.ones(len(arrays), dtype=bool))) == []
    assert tracemalloc.get_traced_memory()[1] < 8 << 20
    tracemalloc.stop()


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(1, 400), st.data())
def test_linked_sets_share_the_needed_prefix_keys(n, m, data):
    """Two sets with the least overlap that links, in a random common order."""
    if 100 * min(n, m) < 75 * max(n, m):
        return
    shared = least_overlap(n, m)
    order = data.draw(st.randoms(use_true_random=False))
    keys = list(range(n + m - shared))
    order.shuffle(keys)
    a, b = sorted(keys[:n]), sorted(keys[n - shared :])
    assert len(set(a) & set(b)) == shared and len(b) == m
    both = set(a[: ngram_join.prefix_length(n)]) & set(b[: ngram_join.prefix_length(m)])
    assert len(both) >= max(ngram_join.needed_keys(n), ngram_join.needed_keys(m))


def test_components_of_long_paths(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, 1001), (1002, 1001), (2000, 2000)]
    got = dict(map(tuple, roots(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    assert got == {**{k: 0 for k in range(201)}, 1000: 1000, 1001: 1000, 1002: 1000}


def test_line_dedup_equals_brute_force(spark):
    got = {r.doc_id: (r.text, r.n_removed) for r in QUERIES["op2_line_dedup"](spark, MEDIUM).collect()}
    assert got == brute.lines_removed(rows_of(spark, MEDIUM))


def test_line_dedup_of_many_near_lines(spark):
    """Lines of which the earliest candidate does not match, so that the second round is needed."""
    base = [f"w{k}" for k in range(40)]
    rows = []
    for doc_id in range(60):
        lines = []
        for k in range(4):
            words = [w if (i * 7 + doc_id * 3 + k) % 13 > (doc_id + k) % 5 else f"x{doc_id}-{i}" for i, w in enumerate(base)]
            lines.append(" ".join(words))
        rows.append((doc_id, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup(docs).select("doc.doc_id", "found.*").collect()}
    assert got == brute.lines_removed(rows)


def test_substring_dedup_equals_brute_force(spark):
    got = {r.doc_id: (r.text, r.n_removed) for r in QUERIES["op6_substring_dedup"](spark, MEDIUM).collect()}
    assert got == brute.runs_removed(rows_of(spark, MEDIUM), substring_dedup.sentences_of)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB.!? \n\té", max_size=60))
def test_sentences_add_up_to_the_text(text):
    found = "".join(substring_dedup.sentences_of(text))
    assert found == text or not text[len(found) :].strip()
