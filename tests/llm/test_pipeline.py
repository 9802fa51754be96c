"""The whole pipeline on the smallest tables."""

from __future__ import annotations

import os

import pytest
from conftest import SF_DIR

import corpus_pipeline
from wardgrid.llm import jaccard, shared

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables to read")


def test_pipeline_keeps_one_of_each_group_and_writes_gapless_tokens(spark):
    rows = sorted(corpus_pipeline.run(spark, SF_DIR).collect(), key=lambda r: r["start"])
    assert rows and [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:i]) for i in range(len(rows))]
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)
    docs = shared.read_table(spark, SF_DIR, "documents")
    groups = jaccard.group_documents(spark, docs, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILARITY_PERCENT)
    component = {r["doc_id"]: r["component_id"] for r in groups.collect()}
    kept = {r["doc_id"] for r in rows}
    # One more at most: a group may fall apart where the document that linked it was toxic.
    assert kept <= component.keys() and len({component[i] for i in kept}) >= len(kept) - 1
