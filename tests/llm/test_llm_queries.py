"""Queries against their SQL, and the pipeline against its parts."""

import pytest

import __spark_entry__
import corpus_pipeline
from pressloom.llm.queries import LLM_ORACLE, LLM_QUERIES
from tests.compare import difference, oracle_connection
from tests.conftest import SMALL
from tests.llm.helpers import awkward, empty


@pytest.mark.parametrize("name", list(LLM_ORACLE))
def test_same_answer(spark, name):
    assert difference(LLM_QUERIES[name](spark, SMALL), oracle_connection(SMALL), LLM_ORACLE[name]) is None


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))


def test_pipeline_keeps_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.count() > 0 and rows.columns == [*docs.columns, "shard", "slot"]


@pytest.mark.parametrize("make", [awkward, empty])
def test_stages_on_awkward_rows(spark, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() <= 3 * docs.count()
