"""Registered queries of the text operators: SQL twins where there are some, and the pipeline against its own rules."""

import pytest

import corpus_pipeline
from martlet.llm import queries
from tests.compare import ROOT, difference, duck

SF = "sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(f"{ROOT}/{SF}")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, con, name):
    assert difference(queries.queries()[name](spark, f"{ROOT}/{SF}"), con, queries.oracle_sql()[name]) is None


def test_pipeline(spark):
    sf_dir = f"{ROOT}/{SF}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf_dir)
        assert kept.schema.names == docs.schema.names and 0 < kept.count() <= before.count()
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in kept.collect()}
