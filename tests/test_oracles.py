"""Every registered query against its plain-SQL answer on the smallest tables."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as contract
from cleargrain.oracle.sql import oracles
from cleargrain.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == oracles().keys()
    assert QUERIES.keys() <= contract.queries().keys() and oracles().keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    answer = engine.execute(oracles()[name])
    names = [column[0] for column in answer.description]
    expected = answer.fetchall()
    frame = QUERIES[name](spark, SF)
    assert sorted(frame.columns) == sorted(names)
    got = [tuple(row) for row in frame.select(*names).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_flagship_has_rows(spark):
    frame = contract.entry(spark)
    assert not frame.isEmpty() and datetime.date.fromisoformat(frame.first().order_month + "-01")
