"""The pipeline's stages on the awkward table, and its result from brute force on what the stages keep."""

from __future__ import annotations

from nasty import SCHEMA, documents

import corpus_pipeline
from curatrix.llm.common import stored


def test_stages_keep_columns_and_order(spark, tmp_path):
    docs = spark.createDataFrame(documents(), SCHEMA)
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stored(stage(spark, kept[-1], "")))
        assert kept[-1].columns == docs.columns
    counts = [k.count() for k in kept]
    assert counts[0] > counts[1] >= counts[2] > counts[3] == counts[4]
    ids = [{r[0] for r in k.select("doc_id").collect()} for k in kept]
    assert 3 in ids[3] and not ids[3] & {20, 21}  # one of the copies stays
    assert {30, 31, 32} <= ids[4]
    lengths = {r["doc_id"]: r["n_chars"] for r in kept[4].collect()}
    assert lengths[31] < lengths[30] and lengths[32] < lengths[30]  # the passage went from the later ones
    final = corpus_pipeline.STAGES[-1][1](spark, kept[4], "")
    assert {r[0] for r in final.select("doc_id").distinct().collect()} == ids[4]


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0


def test_run_reads_documents(spark, tmp_path):
    spark.createDataFrame(documents(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
