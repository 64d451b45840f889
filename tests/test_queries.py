"""Every registered query against its SQL in DuckDB, on whole tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from tempestry import oracles, registered

DUCK_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(registered.QUERIES) == set(oracles.ORACLES)
    assert set(registered.QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    actual = entry_module.queries()[name](spark, sf_dir)
    columns = sorted(actual.columns)
    expected = duck.sql(f"select {', '.join(f'{chr(34)}{c}{chr(34)}' for c in columns)} from ({entry_module.oracle_sql()[name]})")
    full = duck.sql(entry_module.oracle_sql()[name])
    assert sorted(full.columns) == columns
    types = dict(actual.dtypes)
    assert [DUCK_TYPES[types[c]] for c in columns] == [str(t) for t in expected.types]
    ours = Counter(tuple(r) for r in actual.select(*(f"`{c}`" for c in columns)).collect())
    theirs = Counter(expected.fetchall())
    assert sum(ours.values()) > 0
    assert ours == theirs


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["event_start_year", "event_type", "fatality_type", "fatality_count"]
    assert result.count() > 0
