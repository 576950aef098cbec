"""Packing against plain tokenization, and the promises about windows."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from tests.conftest import MEDIUM
from tests.llm import odd
from tidemark.llm import packing
from tidemark.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "don't WE'LL 'tis 'start x's a\u00a0b e\u0301 \u0301x ΟΔΟΣ Σ Σ. <|endoftext|> a<|startoftext|>b. ).  hi). \u3000x ½ ñandú.",
    "<|ENDOFTEXT|> BIG Words. <|", "É. ê, ǅ. ɐ. ✓. 日本。", "a\u0338< <\u0338 a<\u0338", "\x1c a\x1cb \x85 x\u2028y", "",
    "İ. ſ, K", "ẞ! ŉ. x'S x'LL. 'VE ß.", "\u200d👨\u200d👩 a\ufe0f.", "e.\u0301 a", "abc.\u0301 a:\u0301 \u0301. A\u030a.",
]


def reference_ids(words, text):
    return words.tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_words_give_the_ids_of_the_whole_text(text):
    words = packing.WordIds(PATH)
    assert np.frombuffer(words.encode(text), "<u4").tolist() == reference_ids(words, text)


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    monkeypatch.setattr(packing, "SEGMENT", 16)
    words = packing.WordIds(PATH)
    text = " ".join(TEXTS[:3]) + " " + odd.prose(5, 300)
    assert np.frombuffer(words.encode(text), "<u4").tolist() == reference_ids(words, text)


@pytest.mark.parametrize("seed", range(20))
def test_differencing_holds_every_item_once_and_balances(seed):
    r = random.Random(seed)
    sizes = [r.randint(1, 1000) for _ in range(r.randint(1, 300))]
    windows = r.randint(1, 40)
    parts = packing.differencing(sizes, windows)
    assert len(parts) == windows and sorted(i for part in parts for i in part) == list(range(len(sizes)))
    sums = [sum(sizes[i] for i in part) for part in parts]
    if len(sizes) > 20 * windows:
        assert max(sums) - min(sums) < 40
    assert max(sums) - min(sums) <= max(sizes)


def check(rows, texts, capacity=4096):
    """``texts``: per id, the texts of its documents. Returns the share of padding."""
    words = packing.WordIds(PATH)
    wanted = defaultdict(int)
    for doc_id, text in texts:
        wanted[doc_id, np.array([*reference_ids(words, text), 2], "<u4").tobytes()] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        assert row.length > 0 and len(row.ids) == 4 * row.length and row.ids_crc32 == zlib.crc32(row.ids)
        by_doc[row.doc_id, row.doc_tokens].append((row.start, bytes(row.ids)))
        by_sequence[row.sequence_id].append((row.offset, row.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    for (doc_id, tokens), pieces in by_doc.items():
        options = [(ids, n) for (d, ids), n in wanted.items() if d == doc_id and len(ids) == 4 * tokens]
        # The pieces are those of each document, cut anywhere, as often as it came.
        covered = sum(len(p) for _, p in pieces)
        assert covered == sum(len(ids) * n for ids, n in options)
        assert all(any(ids[4 * start : 4 * start + len(p)] == p for ids, _ in options) for start, p in pieces)
    assert {(d, len(ids) // 4) for d, ids in wanted} == set(by_doc)
    used = [sum(n for _, n in pieces) for pieces in by_sequence.values()]
    return 1 - sum(used) / (capacity * len(used))


def test_the_table(spark):
    docs = table(spark, MEDIUM, "documents")
    rows = packing.pack(docs.coalesce(1), PATH, 2).collect()
    assert check(rows, [(r.doc_id, r.text) for r in docs.collect()]) < 0.01
    assert len({(r.doc_id, r.start) for r in rows}) == len(rows)


def test_odd_input(spark):
    docs = odd.documents(spark).repartition(3)
    check(packing.pack(docs, PATH, 2).collect(), [(row[0], row[1]) for row in odd.ROWS])
    check(packing.pack(docs, PATH, 2, capacity=7).collect(), [(row[0], row[1]) for row in odd.ROWS], 7)
    assert packing.pack(odd.no_documents(spark), PATH, 2).collect() == []


def test_many_tiny_documents(spark):
    docs = spark.createDataFrame([(i, "a" if i % 3 else None) for i in range(30_000)], "doc_id long, text string").coalesce(1)
    rows = packing.pack(docs, PATH, 2).collect()
    assert check(rows, [(i, "a" if i % 3 else None) for i in range(30_000)]) < 0.1
