"""Facts, marts and insights against brute force on small random tables with hot keys and nulls."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from tempestry.operators import facts, insights, marts
from tempestry.schemas import EVENTS, FACT_EVENT_COLUMNS, FACT_FATALITY_COLUMNS, FATALITIES


@pytest.fixture(scope="module")
def staged():
    rng = random.Random(11)
    day = lambda: rng.choice([None, datetime(2023, rng.randint(1, 12), 5), datetime(2024, 2, 29)])
    events = []
    for key in [None, *map(str, range(60))]:
        start = day()
        events.append(
            (key, "TEXAS", rng.choice(["Hail", "Flood", "Heat", None]), start, start and datetime(2024, 3, 1),
             0, 0, 0, 0, rng.choice([None, 0, 6_000_000_000]), rng.choice([None, 5, 10]), "Public", None, "EG")
        )
    fatalities = [
        (None if i == 7 else str(i), rng.choice(["3", "3", None, *map(str, range(80))]), rng.choice(["I", "D", "x", None]),
         day(), 40, rng.choice(["M", "F", None]), None)
        for i in range(900)
    ]
    return events, fatalities


@pytest.fixture(scope="module")
def fact(spark, staged):
    events = facts.fact_events(spark.createDataFrame(staged[0], EVENTS.schema))
    fatalities = facts.fact_fatalities(spark.createDataFrame(staged[1], FATALITIES.schema))
    return events, fatalities


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_fact_columns(spark, fact):
    assert tuple(fact[0].columns) == FACT_EVENT_COLUMNS
    assert tuple(fact[1].columns) == FACT_FATALITY_COLUMNS
    assert {t for _, t in fact[0].dtypes + fact[1].dtypes} == {"string", "bigint", "double", "timestamp"}


def test_year_month_label_of_events(spark):
    row = ("1", "T", "Hail", datetime(2024, 1, 31), datetime(2024, 2, 1), 0, 0, 0, 0, 0, 0, "s", None, "EG")
    df = spark.createDataFrame([row], EVENTS.schema)
    assert facts.fact_events(df).first().event_start_year_month == "2024-2"
    assert facts.fact_events(df, fix_year_month=True).first().event_start_year_month == "2024-1"


def test_costliest(staged, fact):
    cost = {}
    for event in staged[0]:
        group = (event[3] and event[3].year, event[2])
        cost.setdefault(group, None)
        if event[9] is not None and event[10] is not None:
            cost[group] = (cost[group] or 0) + event[9] + event[10]
    assert rows_of(marts.costliest_events(fact[0])) == Counter((*k, v) for k, v in cost.items())


def test_by_month_and_sex(staged, fact):
    dated = [f for f in staged[1] if f[3]]
    months = Counter((f[3].year, f[3].month) for f in dated)
    by_month = marts.fatalities_by_month(fact[1])
    assert rows_of(by_month) == Counter((*k, n) for k, n in months.items())
    assert [(r[0], r[1]) for r in by_month.collect()] == sorted(months)
    sexes = Counter((f[3].year, {"M": "Male", "F": "Female"}.get(f[5], "Unknown")) for f in dated)
    assert rows_of(marts.fatalities_by_sex(fact[1])) == Counter((*k, n) for k, n in sexes.items())


def brute_force_types(events, fatalities):
    label = {"I": "Indirect", "D": "Direct"}
    count = {}
    for event in events:
        for fatality in fatalities:
            if event[0] is not None and event[0] == fatality[1]:
                group = (event[3] and event[3].year, event[2], label.get(fatality[2], "Unknown"))
                count[group] = count.get(group, 0) + (fatality[0] is not None)
    return Counter((*k, n) for k, n in count.items())


def test_type_by_event_type(staged, fact):
    assert rows_of(marts.fatality_type_by_event_type(*fact)) == brute_force_types(*staged)


def test_group_of_a_fatality_without_id_counts_zero(spark, staged):
    event = next(e for e in staged[0] if e[0] == "3")
    fatality = (None, "3", "D", None, None, None, None)
    result = marts.fatality_type_by_event_type(
        facts.fact_events(spark.createDataFrame([event], EVENTS.schema)),
        facts.fact_fatalities(spark.createDataFrame([fatality], FATALITIES.schema)),
    )
    assert [(r.fatality_type, r.fatality_count) for r in result.collect()] == [("Direct", 0)]


def test_undecoded_type_is_an_error_not_a_lost_row(spark, fact):
    odd = spark.createDataFrame([("1", "3", "D")], "fatality_id string, event_id string, fatality_type string")
    with pytest.raises(PySparkException, match="not a decoded type"):
        marts.fatality_type_by_event_type(fact[0], odd).collect()


def test_insights(spark):
    types = spark.createDataFrame(
        [(2024, "Heat", "Direct", 5), (2024, "Heat", "Indirect", 5), (2024, "Flood", "Unknown", 1), (None, "Heat", "Direct", 2)],
        "event_start_year bigint, event_type string, fatality_type string, fatality_count bigint",
    )
    assert rows_of(insights.top_fatality_type(types)) == Counter(
        [(2024, "Heat", "Direct", 5), (2024, "Flood", "Unknown", 1), (None, "Heat", "Direct", 2)]
    )
    assert {(r.event_start_year, r.event_type, r.fatality_type): r.share for r in insights.fatality_balance(types).collect()} == {
        (2024, "Heat", "Direct"): 50.0, (2024, "Heat", "Indirect"): 50.0, (2024, "Flood", "Unknown"): 100.0,
        (None, "Heat", "Direct"): 100.0,
    }
    months = spark.createDataFrame(
        [(2023, 1, 4), (2023, 6, 9), (2024, 7, 2), (2024, 2, 2)],
        "fatality_year bigint, fatality_month bigint, fatality_count bigint",
    )
    assert rows_of(insights.peak_month(months)) == Counter([(2023, 6, 9), (2024, 2, 2)])
    sexes = spark.createDataFrame(
        [(2024, "Male", 720), (2024, "Female", 255), (2024, "Unknown", 25)],
        "fatality_year bigint, fatality_sex string, fatality_count bigint",
    )
    assert {r.fatality_sex: r.share for r in insights.sex_share(sexes).collect()} == {"Male": 72.0, "Female": 25.5, "Unknown": 2.5}
    costs = spark.createDataFrame(
        [(2024, "Hail", 5), (2024, "Heat", None), (2023, "Hail", 5), (None, "Flood", 99), (2024, "Flood", 7)],
        "event_start_year bigint, event_type string, cost bigint",
    )
    assert [tuple(r) for r in insights.top_cost(costs, 2).collect()] == [(2024, "Flood", 7), (2023, "Hail", 5)]
    ranks = {(r.event_start_year, r.event_type): r.cost_rank for r in insights.cost_rank(costs).collect()}
    assert ranks == {(2024, "Flood"): 1, (2024, "Hail"): 2, (2024, "Heat"): 3, (2023, "Hail"): 1}
