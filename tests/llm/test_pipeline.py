from __future__ import annotations

import re
from pathlib import Path

import pytest

import corpus_pipeline
from tests.conftest import MEDIUM, ROOT
from tests.llm import brute, odd
from tidemark.llm import mixing, toxicity
from tidemark.llm.common import staged, table


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, MEDIUM, "documents"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, MEDIUM), re.sub(r"\W", "-", name))
        out.append(docs)
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing"
    ]
    for step in steps[:-1]:
        assert step.schema == steps[0].schema
    counts = [step.count() for step in steps]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0


def test_each_stage_by_brute_force(spark, steps):
    documents, clean, exact, near, decontaminated, mixed = steps
    model = toxicity.fit(documents, table(spark, MEDIUM, "labels"))
    scored = toxicity.score(documents, model).select("doc.doc_id", "found.score").collect()
    assert ids(clean) == {r.doc_id for r in scored if r.score < toxicity.REJECT}
    best: dict[str, tuple] = {}
    for r in clean.collect():
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        best[key] = min(best.get(key, (1,)), (-len(r.text or ""), r.doc_id))
    assert ids(exact) == {doc_id for _, doc_id in best.values()}
    found = brute.components([(r.doc_id, r.text) for r in exact.collect()])
    assert ids(near) == {component for _, _, component in found}
    passages = [re.findall(r"\w+", r.text.lower()) for r in table(spark, MEDIUM, "benchmark").collect()]
    whole = [" " + " ".join(p) + " " for p in passages]
    leaked = {r.doc_id for r in near.collect() if any(p in " " + " ".join(re.findall(r"\w+", r.text.lower())) + " " for p in whole)}
    assert leaked and not leaked & ids(decontaminated)
    assert ids(mixed) == {
        r.doc_id
        for r in mixing.sample(decontaminated, corpus_pipeline.MIX_TARGETS, corpus_pipeline.MIX_FRACTION).collect()
    }


def test_odd_documents(spark):
    docs = odd.documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, MEDIUM)
        assert after.schema == docs.schema and after.exceptAll(docs).count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.no_documents(spark), MEDIUM).collect() == []


def test_the_rest_of_the_library_does_not_import_this():
    others = [p for d in ("tidemark", "checks") for p in Path(ROOT, d).rglob("*.py") if "llm" not in p.parts]
    assert others and not [p for p in others if "llm" in p.read_text()]


def test_run_is_all_stages_in_a_row(spark):
    from tests.conftest import SMALL

    docs = table(spark, SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SMALL), re.sub(r"\W", "-", name))
    whole = corpus_pipeline.run(spark, SMALL)
    assert whole.columns == docs.columns and whole.count() > 0
    assert whole.exceptAll(docs).count() == docs.exceptAll(whole).count() == 0
