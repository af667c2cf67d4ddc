"""Every registered query against its SQL counterpart, and what its plan must not contain."""

from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from basketry.plans import oracle
from basketry.plans.queries import PARAMETERS, registry
from shop import plan

FOLDER = "/root/testdata/sf0.001"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

QUERIES = registry()
ORACLE = oracle.statements(PARAMETERS)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def ordered(records):
    return sorted(map(repr, records))


def check_plan(text):
    """No pairing of everything, no Python rows, and one task only for one row per map task."""
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas", text)
    lines = text.splitlines()
    for number, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[]" in lines[number + 1]


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    check_plan(plan(result))
    columns = sorted(result.columns)
    cursor = duck.execute(ORACLE[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    actual = [tuple(row[c] for c in columns) for row in result.collect()]
    assert ordered(actual) == ordered(expected)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert ORACLE.keys() <= driver.oracle_sql().keys()


def test_entry_is_stable(spark):
    result = driver.entry(spark)
    assert result.columns == [
        "customer_id", "required_check_measure", "group_name", "offer_discount_depth",
    ]
    assert result.count() == 144
