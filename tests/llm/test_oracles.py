"""The registered queries that SQL can express, against DuckDB on whole tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tempestry.llm import registered


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    actual = registered.QUERIES[name](spark, sf_dir)
    columns = sorted(actual.columns)
    expected = duck.sql(f"select {', '.join(columns)} from ({registered.ORACLES[name]})")
    ours = Counter(tuple(r) for r in actual.select(*columns).collect())
    assert sum(ours.values()) > 0 and ours == Counter(expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(registered.QUERIES) - set(registered.ORACLES)))
def test_other_queries_return_their_rows(spark, duck, sf_dir, name):
    rows = registered.QUERIES[name](spark, sf_dir).collect()
    whole = {"op6": "pages"}.get(name.split("_")[0], "documents")
    assert len(rows) >= duck.sql(f"select count(*) from {whole}").fetchall()[0][0]


@pytest.mark.parametrize("name", ["op4_secret_scan", "op8_exact_dedup"])
def test_native_operators_have_no_python_worker(spark, sf_dir, name):
    plan = registered.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
