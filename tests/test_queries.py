"""Registered queries against their SQL in DuckDB."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from workload.registry import QUERIES, SQL as ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_type", "presentation_week", "total_clicks", "distinct_students"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert word not in plan
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == sorted(repr(r) for r in result.fetchall())
