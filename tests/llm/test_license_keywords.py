"""No alternative of a pattern is dead behind its own keyword or gate."""

from __future__ import annotations

import re
from itertools import product
from re import _parser

from tests.llm.test_license_scan import scanned
from tidemark.llm.license_rules import BASE_RULES, rules


def texts_of(parsed) -> list[str]:
    """All texts that a pattern matches; of a range its first character."""
    parts = []
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            parts.append([chr(value)])
        elif name == "IN":
            parts.append([chr(v if str(kind) == "LITERAL" else v[0]) for kind, v in value])
        elif name == "BRANCH":
            parts.append([t for branch in value[1] for t in texts_of(branch)])
        elif name == "SUBPATTERN":
            parts.append(texts_of(value[-1]))
        elif name == "MAX_REPEAT":
            low, high, inner = value
            parts.append([t for n in {low, high} for t in repeated(inner, n)])
        else:
            raise ValueError(name)
    return ["".join(p) for p in product(*parts)]


def repeated(inner, n: int) -> list[str]:
    return ["".join(p) for p in product(texts_of(inner), repeat=n)]


def test_every_alternative_passes_its_keyword_and_gate():
    for rule in (*BASE_RULES, *rules()):
        texts = texts_of(_parser.parse(rule.pattern))
        for text in (texts[0], texts[-1]):
            assert re.fullmatch(rule.pattern, text)
        dead = [t for t in texts if rule.keyword not in t or rule.gate() not in t]
        assert not dead, (rule, dead[:3])


def found_by(text: str, table) -> tuple[set[str], float]:
    """Labels and score by plain loops: detections that no other one contains with a higher priority, or the same and longer."""
    line, found = f" {text} ", []
    for number, rule in enumerate(table):
        if rule.keyword in line:
            for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", line):
                first = line[: m.start()].count(" ") - 1
                found.append((first, first + m[0].count(" "), rule.priority, number))
    kept = [
        n for k, (a, b, p, n) in enumerate(found)
        if not any(
            c <= a and b <= d and (q > p or q == p and (d - c > b - a or (c, d) == (a, b) and m < n))
            for j, (c, d, q, m) in enumerate(found) if j != k
        )
    ]
    return {table[n].label for n in kept}, max((table[n].confidence for n in kept), default=0.0)


def test_every_rule_finds_something_no_other_rule_finds(spark):
    table = rules()
    assert len(table) >= 300
    texts = [[t for t in {ts[0], ts[-1]}] for ts in (texts_of(_parser.parse(rule.pattern)) for rule in table)]
    idle = []
    for k, rule in enumerate(table):
        others = [*table[:k], *table[k + 1 :]]
        if all(found_by(t, others) == found_by(t, table) for t in texts[k]):
            idle.append(rule)
    assert not idle, (len(idle), [(r.label, r.pattern) for r in idle])
    # The plain loops agree with the scan, base rules aside.
    sample = {k: t[0] for k, t in enumerate(texts)}
    for k, row in scanned(spark, sample).items():
        labels, score = found_by(sample[k], table)
        base, base_score = found_by(sample[k], BASE_RULES)
        assert row.labels == ",".join(sorted(labels | base)) and row.score == max(score, base_score), sample[k]


def test_wtfpl_by_both_names(spark):
    out = scanned(
        spark,
        {
            1: "Distributed under the WTFPL, version 2",
            2: "Do What The Fuck You Want To Public License",
            3: "This code is licensed under the WTFPL.",
            4: "WTFPL",
            5: "what the fuck you want",
        },
    )
    assert {k: r.labels for k, r in out.items()} == {1: "wtfpl", 2: "wtfpl", 3: "wtfpl", 4: "wtfpl", 5: ""}
