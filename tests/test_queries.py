"""Every registered query against its SQL on the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return connection


def comparable(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


CORE = [query.__name__ for query in contract._QUERIES]


@pytest.mark.parametrize("name", CORE)
def test_query_matches_sql(spark, tables, name):
    df = contract.queries()[name](spark, SF)
    result = tables.execute(contract.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    assert comparable(df.columns, df.collect()) == comparable(names, result.fetchall())


def test_every_query_has_sql():
    assert set(CORE) <= set(contract.queries())
    assert set(CORE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 1500
