"""Lines of few words are deduplicated like all others."""

from __future__ import annotations

from tests.conftest import MEDIUM
from tests.llm import brute
from tidemark.llm import line_dedup
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

ROWS = [
    (1, "All rights reserved\nHome\n\nRead more\none two three"),
    (2, "all RIGHTS reserved\nhome  home\n \nread\none two three four"),
    (3, "reserved all rights\nmore read\none two\none two five"),
    (4, "four three two one\none two three four five\nother words here\nhome page"),
    (5, None),
]


def test_short_lines(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.text or "", r.n_removed) for r in line_dedup.dedup(docs).select("doc.doc_id", "found.*").collect()}
    # Three words match four that have them; two words and three do not match.
    assert got[2] == (" \nread", 3) and got[3] == ("one two\none two five", 2)
    assert got == brute.lines_removed(ROWS) | {5: ("", 0)}


def test_short_lines_of_the_table(spark):
    rows = sorted(map(tuple, table(spark, MEDIUM, "documents").select("doc_id", "text").collect()))
    got = {r.doc_id: (r.text, r.n_removed) for r in QUERIES["op2_line_dedup"](spark, MEDIUM).collect()}
    assert got == brute.lines_removed(rows)
