"""Every registered query against its SQL, run by another engine on the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from stowage.oracle import ORACLE
from stowage.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(name, spark, sf_dir, duck):
    frame = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(columns)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert _rows(frame.columns, [tuple(r) for r in frame.collect()]) == _rows(columns, result.fetchall())


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
