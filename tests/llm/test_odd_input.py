"""Every operator on documents of every odd kind, and on none."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm import brute, odd
from tidemark.llm import (
    decontaminate,
    exact_dedup,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    substring_dedup,
    toxicity,
)


@pytest.fixture(scope="module")
def docs(spark):
    return odd.documents(spark).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(4, 1, 1), (4, 1, 0), (6, 1, 0), (7, 0, None), (None, 1, 1), (10, 1, 0)], "doc_id long, quality int, toxic int"
    )


def benchmark(spark):
    rows = [(1, odd.prose(2, 80)), (1, odd.prose(2, 80)), (2, None), (3, ""), (4, "two words"), (None, odd.prose(9, 30))]
    return spark.createDataFrame(rows, "item_id long, text string")


def filters(spark, labels):
    return {
        "toxicity": lambda d: toxicity.keep_clean(d, toxicity.fit(d, labels)),
        "exact": exact_dedup.keep_first,
        "near": ngram_join.keep_one,
        "benchmark": lambda d: decontaminate.keep_clean(d, benchmark(spark)),
    }


@pytest.mark.parametrize("name", ["toxicity", "exact", "near", "benchmark"])
def test_filters_keep_columns_and_stand_an_empty_table(spark, docs, labels, name):
    kept = filters(spark, labels)[name](docs)
    assert kept.schema == docs.schema
    assert kept.exceptAll(docs).count() == 0
    assert filters(spark, labels)[name](odd.no_documents(spark)).collect() == []


def test_exact_dedup(spark, docs):
    rows = exact_dedup.decisions(docs).collect()
    assert len(rows) == len(odd.ROWS)
    # Rows 1 to 3 and one without an id are empty once spaces are gone; 3 has the most code points.
    empty = [r for r in rows if r.group_size == 4]
    assert {(r.doc_id, r.keep_id, r.kept) for r in empty} == {(1, 3, False), (2, 3, False), (3, 3, True), (None, 3, False)}
    # Six rows have the same words; 8 has two more spaces. Equal rows of one id stay once at most.
    same = [r for r in rows if r.group_size == 6]
    assert sorted((r.doc_id is None, r.doc_id, r.kept) for r in same if r.doc_id) == [
        (False, 6, False), (False, 7, False), (False, 7, False), (False, 7, False), (False, 8, True)
    ]
    assert sum(r.kept for r in rows) == exact_dedup.keep_first(docs).count()
    assert exact_dedup.decisions(odd.no_documents(spark)).collect() == []


def test_exact_dedup_of_equal_rows_keeps_one(spark):
    docs = spark.createDataFrame([(7, "a b")] * 5 + [(None, "c")] * 3, "doc_id long, text string")
    assert sorted(map(str, exact_dedup.decisions(docs).filter("kept").select("doc_id").collect())) == [
        "Row(doc_id=7)", "Row(doc_id=None)"
    ]
    assert exact_dedup.keep_first(docs).count() == 2


def test_a_full_filter_changes_nothing(spark, docs):
    few = exact_dedup.decisions(docs, max_bits=exact_dedup.BITMAP_BITS)
    assert few.exceptAll(exact_dedup.decisions(docs)).count() == 0


def test_near_copies(spark, docs):
    rows = sorted(map(tuple, ngram_join.components(docs).collect()), key=str)
    assert rows == brute.components([(r[0], r[1]) for r in odd.ROWS])
    assert ngram_join.components(odd.no_documents(spark)).collect() == []


def test_toxicity(spark, docs, labels):
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).select("doc.doc_id", "found.*").collect()
    assert len(rows) == len(odd.ROWS) and all(0 <= r.score <= 1 for r in rows)
    nothing = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, nothing).select("found.score").collect()} == {0.0}
    assert toxicity.score(odd.no_documents(spark), nothing).collect() == []


def test_lines_and_spans(spark, docs):
    for dedup, counted in ((line_dedup.dedup, "n_lines"), (substring_dedup.dedup, "n_sentences")):
        rows = dedup(docs).select("doc.doc_id", F.col("doc.text").alias("before"), "found.*").collect()
        assert len(rows) == len(odd.ROWS)
        for row in rows:
            assert row.n_removed or row.text == row.before
            assert row[counted] >= row.n_removed
        assert dedup(odd.no_documents(spark)).collect() == []


def test_mixing(spark, docs):
    drawn = mixing.sample(docs, {"source": 0.0, "lang": 1.0}, 1.0)
    assert {"mix_topic", "mix_tokens", "mix_probability", "mix_weight"} <= set(drawn.columns)
    assert len(drawn.columns) == len(set(drawn.columns))
    rows = drawn.collect()
    assert all(0 < r.mix_probability <= 1 and r.doc_id != 3 for r in rows)
    assert mixing.sample(odd.no_documents(spark), {}, 0.5).collect() == []


def test_decontamination(spark, docs):
    rows = decontaminate.contaminations(docs, benchmark(spark)).collect()
    assert {(r.doc_id, r.item_id) for r in rows if r.item_id == 4} == {(5, 4)}
    assert {r.doc_id for r in rows if r.item_id == 1} == {6, 7, 8, 9, None}
    assert decontaminate.contaminations(docs, benchmark(spark).limit(0)).collect() == []
    assert decontaminate.contaminations(odd.no_documents(spark), benchmark(spark)).collect() == []


def test_license_scan(spark, docs):
    got = license_scan.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    want = [(r[0], *brute.license_places(r[1])) for r in odd.ROWS]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert license_scan.scan(odd.no_documents(spark)).collect() == []
