"""The pipeline's stages on the small tables: columns, order, and what each leaves."""

from __future__ import annotations

import corpus_pipeline
from lakegate.llm import decontaminate
from lakegate.llm.common import stage
from lakegate.llm.queries import table

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = documents = table(spark, FOLDER, "documents")
    left = []
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, FOLDER), "test-pipeline")
        left.append(docs)
    assert all(d.columns == documents.columns for d in left[:-1])
    counts = [documents.count(), *(d.count() for d in left)]
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > 0
    assert left[1].select("text").distinct().count() == counts[2]
    leaks = decontaminate.contamination(left[3], table(spark, FOLDER, "benchmark"))
    assert leaks.where("size(spans) > 0").count() == 0


def test_stages_accept_no_documents(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, FOLDER), "test-pipeline")
    assert docs.count() == 0
