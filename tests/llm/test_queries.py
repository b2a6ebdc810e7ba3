"""The registered queries against their SQL, and the pipeline's stages."""

import os

import duckdb
import pytest

import corpus_pipeline
from tallyspan.llm import oracles, queries

FOLDER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")


@pytest.mark.parametrize("name", list(oracles.oracle_sql()))
def test_query(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(FOLDER):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    expected = duck.execute(oracles.oracle_sql()[name])
    names = [c[0] for c in expected.description]
    found = queries.queries()[name](spark, FOLDER)
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(repr, map(tuple, found.select(names).collect()))) == sorted(map(repr, expected.fetchall()))


def test_every_operator_has_a_query():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.queries()) == list(range(1, 14))


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        left = spark.read.parquet(f"{tmp_path}/{name}")
        assert left.columns == docs.columns
        sizes.append(left.count())
        docs = left
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.6 * sizes[0]
    assert docs.count() == docs.select("doc_id").distinct().count()
    packed = corpus_pipeline.run(spark, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_pipeline_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).collect() == []
