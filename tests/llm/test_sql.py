"""The queries that SQL can express, against it, over whole tables."""

from pathlib import Path

import duckdb
import pytest

from classweave.llm import oracles, queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", oracles.ORACLES)
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = queries.QUERIES[name](spark, sf_dir)
    relation = duck.sql(oracles.ORACLES[name])
    place = [relation.columns.index(c) for c in result.columns]
    assert sorted(relation.columns) == sorted(result.columns)
    found = sorted((tuple(row) for row in result.collect()), key=repr)
    expected = sorted((tuple(row[i] for i in place) for row in relation.fetchall()), key=repr)
    assert len(found) > 0
    assert found == expected


@pytest.mark.parametrize("name", ["op1_secrets", "op3_url_filter"])
def test_native_queries_have_no_python(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
