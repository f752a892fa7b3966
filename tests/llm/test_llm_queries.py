import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline  # noqa: E402
from __spark_entry__ import queries  # noqa: E402
from packwright.llm import decontamination, ngram_join, toxicity  # noqa: E402
from packwright.llm.frames import read  # noqa: E402
from packwright.llm.queries import LLM_QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def test_one_query_for_each_operator():
    assert {n.split("_")[0] for n in LLM_QUERIES} == {f"op{i}" for i in range(1, 11)}
    assert set(LLM_QUERIES) | {"pipeline"} <= set(queries()) and len(corpus_pipeline.STAGES) == 5


def test_stages_keep_columns_and_clean_documents(spark):
    docs = read(spark, SMALL, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SMALL)
        assert docs.columns == before.columns, name
        docs = spark.createDataFrame(docs.collect(), before.schema)
    kept = {r["doc_id"]: r for r in docs.collect()}
    model = toxicity.train(read(spark, SMALL, "documents"), read(spark, SMALL, "labels"))
    bad = {r["doc_id"] for r in toxicity.score(read(spark, SMALL, "documents"), model).where("predicted = 1").collect()}
    fine = read(spark, SMALL, "documents").where(~F.col("doc_id").isin(list(bad) or [-1]))
    same = {r["doc_id"] for r in ngram_join.classes(fine).where("doc_id != component_id").collect()}
    leaky = {r["doc_id"] for r in decontamination.leaks(fine, read(spark, SMALL, "benchmark")).collect()}
    assert not set(kept) & (bad | same)
    assert set(texts) - bad - same - leaky <= set(kept)
    assert all(r["n_chars"] == len(r["text"]) for r in kept.values())
    final = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r["doc_id"] for r in final.collect()} == set(kept)
