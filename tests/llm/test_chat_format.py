from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat_format


def formatted(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.formatted(turns.repartition(3))
    return {r.conv_id: r for r in out.withColumn("turns", chat_format.read_back(F.col("formatted"))).withColumn("learned", chat_format.learned_text(F.col("segments"))).collect()}


def test_marks_and_merging(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c"),
        (1, 4, "assistant", "d"), (1, 5, "tool", "e"),
    ]
    out = formatted(spark, rows)[1]
    assert out.formatted == (
        "<s><<SYS>>be kind<</SYS>></s><s>[INST]a[NEXT]b[/INST]</s><s>c[NEXT]d</s><s>[ROLE]tool[/ROLE]e</s>"
    )
    assert out.learned == "cd"
    assert "".join(s.text for s in out.segments) == out.formatted


def test_every_text_comes_back(spark):
    r = random.Random(4)
    pieces = [*chat_format.CONTROLS, "\\", "\\\\", "<", "[", "/", "s>", "</", "INST]", "\n", "", "é", "x", "$1", "\\E", "$"]
    roles = ["user", "assistant", "system", "tool", "[ROLE]", "</s>", "", "User", "\\"]
    rows, want = [], {}
    for conv in range(300):
        turns = [(r.choice(roles), "".join(r.choice(pieces) for _ in range(r.randrange(7)))) for _ in range(r.randrange(1, 9))]
        want[conv] = turns
        rows += [(conv, k, *turn) for k, turn in enumerate(turns)]
    out = formatted(spark, rows)
    for conv, turns in want.items():
        assert [(t.role, t.text) for t in out[conv].turns] == turns
        assert out[conv].learned == "".join(text for role, text in turns if role == "assistant")
        assert "".join(s.text for s in out[conv].segments) == out[conv].formatted


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "late"), (None, None, "user", "first"), (5, 0, None, None), (5, 0, None, None),
        (6, 1, "user", "b"), (6, 1, "user", "a"), (7, 0, "assistant", "long " * 200_000),
    ]
    out = formatted(spark, rows)
    assert [t.text for t in out[None].turns] == ["first", "late"]
    assert [(t.role, t.text) for t in out[5].turns] == [("", ""), ("", "")]
    assert [t.text for t in out[6].turns] == ["a", "b"]
    assert out[7].learned == "long " * 200_000
    assert formatted(spark, []) == {}


@pytest.mark.parametrize("n", [3000])
def test_a_conversation_of_many_turns(spark, n):
    rows = [(1, k, "user" if k % 3 else "assistant", f"t{k}") for k in range(n)]
    out = formatted(spark, rows)[1]
    assert [t.text for t in out.turns] == [f"t{k}" for k in range(n)]
