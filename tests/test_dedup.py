import random

import pytest
from pyspark.sql import functions as F

from tempestry.operators import dedup
from tempestry.schemas import FATALITIES


def sort_key(value):
    return (value is not None, value if value is not None else "")


@pytest.fixture
def brute_force():
    def first(rows, key=0):
        best = {}
        for row in rows:
            rest = [sort_key(v) for i, v in enumerate(row) if i != key]
            if row[key] not in best or rest < best[row[key]][0]:
                best[row[key]] = (rest, row)
        return sorted((tuple(row) for _, row in best.values()), key=lambda r: [sort_key(v) for v in r])

    return first


def test_first_per_key_against_brute_force(spark, brute_force):
    rng = random.Random(5)
    pick = lambda options: rng.choice(options)
    rows = [(pick([None, "a", "b", "c", *map(str, range(40))]), pick([None, "x", "y"]), pick([None, "1", "2"])) for _ in range(600)]
    df = spark.createDataFrame(rows, "k string, a string, b string").repartition(7)
    result = dedup.first_per_key(df, "k").collect()
    assert sorted((tuple(r) for r in result), key=lambda r: [sort_key(v) for v in r]) == brute_force(rows)


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A third of the rows under one key, and a third without key, leave the map tasks as single rows."""
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    result = dedup.first_per_key(df, "k")
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan and "Final" in plan
    assert result.count() == 10_002
    assert {r.k: r.v for r in result.filter("k is null or k = 'hot'").collect()} == {"hot": 0, None: 2}


def test_latest_load_wins(rows):
    df = rows(
        [*FATALITIES.columns, "load_year"],
        [
            {"fatality_id": "1", "event_id": "a", "load_year": "2023"},
            {"fatality_id": "1", "event_id": "b", "load_year": "2024"},
            {"fatality_id": "2", "event_id": "c", "load_year": "2023"},
        ],
    )
    kept = lambda order: sorted(r.event_id for r in dedup.stage_fatalities(df, order).collect())
    assert kept([]) == ["a", "c"]
    assert kept([F.desc("load_year")]) == ["b", "c"]
