"""Registered queries on the smallest tables, and the pipeline stage by stage."""

import os

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from checks.compare import connect, difference
from palaver.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no input tables")


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.columns == columns, name
        assert 0 < docs.count() <= kept
        kept = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}
