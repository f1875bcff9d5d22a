"""Every registered query against its SQL counterpart at the smallest scale."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from lamina.plans import queries as registered

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def counted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(row[i]) for i in order) for row in rows)


def test_every_query_has_a_counterpart():
    assert set(ORACLES) <= set(QUERIES)
    assert set(registered.queries()) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_matches_its_sql(spark, engine, name):
    result = QUERIES[name](spark, SF_DIR)
    cursor = engine.execute(ORACLES[name])
    columns = [entry[0] for entry in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert counted(result.collect(), result.columns) == counted(cursor.fetchall(), columns)


def test_entry_runs(spark):
    assert registry.entry(spark).count() > 0
