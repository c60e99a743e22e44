"""The pipeline over the smallest tables, stage by stage, against the operators' own verdicts; SQL of the queries."""

from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_stages_keep_columns_and_ids(spark, tmp_path):
    import corpus_pipeline
    from crimestats.llm import host_quality, ngram_join

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = [{r.doc_id for r in docs.collect()}]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, SF)
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == before.columns, name
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        ids.append({r.doc_id for r in docs.collect()})
        assert ids[-1] <= ids[-2]
        if k == 0:
            assert ids[-1] == {r.doc_id for r in host_quality.host_quality(before).where("kept").collect()}
        if k == 2:
            assert ids[-1] == {r.doc_id for r in ngram_join.similar_documents(before, ngram_join.NEAR).where("doc_id = component_id").collect()}
    assert "input_ids" in docs.columns and docs.count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_queries_with_sql_equal_it(spark):
    from oracle_compare import compare

    from crimestats.llm import queries

    keys = list(queries.oracle_sql())
    for key, result in compare(spark, SF, keys, verbose=False).items():
        assert result["rows_match"] and result["schema_match"] and result["hash_match"], (key, result)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    spark.read.parquet(f"{SF}/documents.parquet").where("false").write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and "input_ids" in out.columns
