"""Registered queries of this subpackage, and the pipeline."""

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry
import corpus_pipeline
from caseloom.llm import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", registry.oracles())
def test_query_matches_oracle(spark, name):
    duck = connect(FOLDER)
    for table in ("documents", "embeddings", "labels"):
        duck.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    assert compare(registry.queries()[name](spark, FOLDER).toArrow(), duck.sql(registry.oracles()[name]).to_arrow_table()) == ""


def test_all_are_registered():
    assert {*registry.queries(), "pipeline"} <= set(entry.queries())
    assert [k for k in range(1, 14) if not any(n.startswith(f"op{k}_") for n in entry.queries())] == []


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = step(spark, docs, FOLDER)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.dtypes == before.dtypes
    tokens = docs.count()
    assert 0 < tokens and corpus_pipeline.run(spark, FOLDER).count() == tokens
    assert all(len(r["ids"]) == r["n_tokens"] for r in docs.collect())
