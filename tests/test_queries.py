"""Every query against its oracle on the smallest tables, and the shape of its plan."""

import os
from collections import Counter

import pytest

from sumweave.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["supplier", "part", "lineitem", "events"]
# Global aggregates and a top-n report end in one partition by nature.
SINGLE = {"inventory", "non_empty_buckets", "recent_runs"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan
    assert name in SINGLE or "SinglePartition" not in plan
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
