"""The text operators as registered: against their SQL on whole tables, and the pipeline against its own."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import connect, difference
from tideferry.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, tables, name):
    assert difference(QUERIES[name](spark, FOLDER), tables, ORACLE[name]) is None


def test_pipeline_equals_sql(spark, tables):
    assert difference(corpus_pipeline.run(spark, FOLDER), tables, corpus_pipeline.ORACLE_SQL) is None


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("extra", F.col("doc_id") * 2)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, FOLDER)
        assert left.columns == docs.columns, name
        left.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() > 0
