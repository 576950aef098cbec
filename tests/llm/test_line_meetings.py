"""Sets of words that meet at a word: few rows are moved, and few pairs of unlike sets are candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tidemark.llm import line_dedup

PLAIN = line_dedup.Hot(np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
RANKS = np.arange(line_dedup.SLOTS, dtype=np.uint64)


def met(texts: list[str]) -> line_dedup.Meeting:
    words = line_dedup._words([text.encode() for text in texts])
    parts = []
    for sets in line_dedup._sets(words, RANKS):
        place = words.place_of[sets.line]
        for _, rows in line_dedup.prefix_rows(sets, words.text_of[sets.line], place, PLAIN):
            parts.append((rows, np.ones(len(rows), dtype=bool)))
    return line_dedup.Meeting(parts)


def candidates(texts: list[str], all_of_asked: bool) -> set[tuple[int, int]]:
    pairs = [batch.to_pandas() for batch in met(texts).pairs(all_of_asked)]
    return {(row.later, row.earlier) for batch in pairs for row in batch.itertuples()}


def lines_of(rng: np.random.Generator, n: int, size: int, words: int) -> list[str]:
    return [" ".join(f"w{k}" for k in rng.choice(words, size, replace=False)) for _ in range(n)]


@pytest.mark.parametrize("size", [60, 120, 240, 400])
def test_unlike_long_lines_are_no_candidates(size):
    """128 bits are too few for lines of over 150 words: their candidates grew with the square of the lines."""
    texts = lines_of(np.random.default_rng(7), 200, size, 4 * size)
    assert not candidates(texts, True)


@pytest.mark.parametrize("many", [0, 1 << 30])
def test_near_lines_are_candidates(monkeypatch, many):
    """However sets at a word are compared, and whatever the widths of their parities."""
    monkeypatch.setattr(line_dedup, "MANY_SETS", many)
    rng, texts = np.random.default_rng(3), []
    for size in (4, 9, 30, 39, 42, 80, 98, 103, 200, 248, 255, 300):
        base = [f"b{size}x{k}" for k in range(size)]
        for other in range(6):
            gone = set(rng.choice(size, rng.integers(0, size // 5 + 1), replace=False))
            texts.append(" ".join([w for k, w in enumerate(base) if k not in gone] + [f"n{other}x{k}" for k in range(rng.integers(0, size // 9 + 1))]))
    sets = {}
    for sets_here in line_dedup._sets(line_dedup._words([text.encode() for text in texts])):
        sets |= dict(zip(sets_here.set_id.tolist(), np.split(sets_here.words, sets_here.starts[1:]), strict=True))
    like = {
        frozenset((a, b))
        for a in sets
        for b in sets
        if a != b and line_dedup.overlap(sets[a], sets[b]) >= line_dedup.least_overlap(len(sets[a]), len(sets[b]))
    }
    assert like and like <= {frozenset(pair) for pair in candidates(texts, True)}


def test_second_round_in_parts(monkeypatch):
    """Rows come in batches that cut words apart, in rows of their own; all partners of the sets asked for are found."""
    monkeypatch.setattr(line_dedup, "MEETING_ROWS", 50)
    rng = np.random.default_rng(9)
    base = [f"w{k}" for k in range(50)]
    texts = [" ".join([w for w in base if rng.random() > 0.05] + [f"x{k}"]) for k in range(80)] + lines_of(rng, 20, 30, 40)
    words = line_dedup._words([text.encode() for text in texts])
    parts = []
    for sets in line_dedup._sets(words, RANKS):
        for kind, rows in line_dedup.prefix_rows(sets, words.text_of[sets.line], words.place_of[sets.line], PLAIN):
            key = np.ascontiguousarray(rows["key"]).view(np.int64)
            chosen = np.ascontiguousarray(rows["set_id"]) % 3 == 0
            packed = line_dedup._packed(rows, np.arange(1, len(rows) + 1))
            parts.append(pa.table({"key": key, "kind": np.full(len(rows), kind, dtype=np.int32), "rows": packed, "asked": chosen}))
    batches = pa.concat_tables(parts).sort_by("key").combine_chunks().to_batches(max_chunksize=7)
    got = {pair for b in line_dedup._met_again(iter(batches)) for pair in zip(*(b.column(c).to_pylist() for c in ("later", "earlier")), strict=True)}
    assert len(got) > 500
    assert got == {(later, earlier) for later, earlier in candidates(texts, True) if later % 3 == 0}


def test_rows_of_a_batch_share_buckets(spark):
    """Once a row per prefix word was shuffled; now one per bucket and kind."""
    rng = np.random.default_rng(5)
    docs = spark.createDataFrame([(k, "\n".join(lines_of(rng, 20, 30, 5000))) for k in range(100)], "doc_id long, text string")
    packed = line_dedup.packed_rows(docs.coalesce(1), RANKS, PLAIN, 16).collect()
    assert len(packed) == 2 * 16
    lines = [r for r in packed if r.kind == line_dedup.LINE_KIND]
    assert sum(len(r.rows) for r in lines) == 2000 * line_dedup.LINE.itemsize
    n = sum(len(r.rows) // line_dedup.set_type(r.kind).itemsize for r in packed if r.kind != line_dedup.LINE_KIND)
    assert n == 2000 * line_dedup.prefix_words(np.array([30]))[0]


def test_hot_words_in_blocks(spark, monkeypatch):
    """The lines of words that many sets share are compared in pairs of blocks, and all of them are."""
    monkeypatch.setattr(line_dedup, "HOT_SETS", 20)
    monkeypatch.setattr(line_dedup, "SAMPLE_SHARE", 1)
    rng, rows = np.random.default_rng(11), []
    for doc_id in range(60):
        near = ["posted by", *(f"p{k}" for k in range(10) if k not in rng.choice(10, 2))]
        rows.append((doc_id, "\n".join([f"posted by user{doc_id % 50} on monday", " ".join(near), f"posted on monday {doc_id}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    hot, _ = line_dedup.hot_words(docs, line_dedup.slot_ranks(docs))
    assert len(hot.word) and hot.blocks.max() > 2
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup(docs).select("doc.doc_id", "found.*").collect()}
    assert got == brute.lines_removed(rows)
