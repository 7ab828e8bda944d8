"""The registered queries against their SQL, and the pipeline stage by stage."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from sumweave.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    cursor = connection.execute(ORACLE[name])
    names = sorted(d[0] for d in cursor.description)
    at = [[d[0] for d in cursor.description].index(n) for n in names]
    assert Counter(tuple(r[n] for n in names) for r in QUERIES[name](spark, SF).collect()) == Counter(tuple(r[i] for i in at) for r in cursor.fetchall())


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        assert 0.5 * before < docs.count() <= before
        before = docs.count()
    assert {r["same"] for r in docs.select("same").distinct().collect()} == {True}


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
