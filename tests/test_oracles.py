"""Every registered query against its SQL, over whole tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from workload import oracles, queries

QUERIES, SQL = queries.QUERIES, oracles.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else value + 0.0
        return value

    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.items() <= driver.queries().items()
    assert SQL.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    found = _canonical(result.columns, [tuple(row) for row in result.collect()])
    plan = result._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in plan
    expected_relation = duck.sql(SQL[name])
    expected = _canonical(expected_relation.columns, expected_relation.fetchall())
    assert found[0] == expected[0]
    assert len(found[1]) == len(expected[1])
    assert len(found[1]) > 0
    assert found[1] == expected[1]
    # Numbers keep their kind, so that hashes of the values agree too.
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date"}
    types = dict(zip(expected_relation.columns, map(str, expected_relation.types)))
    for column, spark_type in result.dtypes:
        assert kinds.get(types[column]) == spark_type, f"{column}: {types[column]} and {spark_type}"


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["o_orderkey", "Heart_Attack_Probability", "Predicted_Class"]
    assert result.count() == 1500
