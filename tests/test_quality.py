from collections import Counter

from tempestry.operators import quality


def failures(report):
    return {(r.check, r.table, r.column): r.failures for r in report.collect()}


def test_checks_count_failures(rows):
    child_columns = ["fatality_id", "event_id", "fatality_type", "fatality_date", "fatality_sex"]
    records = [("1", "a", "D", "x", "M"), ("1", "a", "I", "x", "F"), ("2", "z", "R", None, None), ("3", "z", "R", None, "Q"),
               (None, None, None, "x", "W"), (None, "y", "d", "x", "M"), ("2", "b", "D", "x", "M")]
    child = rows(child_columns, [dict(zip(child_columns, r)) for r in records])
    parent = rows(["event_id", "event_start_date"], [{"event_id": "a"}, {"event_id": "b", "event_start_date": "x"}, {"event_id": None}])
    assert failures(quality.all_checks(parent, child)) == {
        ("unique", "stg_fatalities", "fatality_id"): 2,
        ("unique", "stg_events", "event_id"): 0,
        ("not_null", "stg_fatalities", "fatality_id"): 2,
        ("not_null", "stg_fatalities", "fatality_date"): 2,
        ("not_null", "stg_events", "event_id"): 1,
        ("not_null", "stg_events", "event_start_date"): 2,
        ("relationships", "stg_fatalities", "event_id"): 3,
        ("accepted_values", "stg_fatalities", "fatality_type"): 2,
        ("accepted_values", "stg_fatalities", "fatality_sex"): 2,
    }
    assert Counter(tuple(r) for r in quality.orphan_keys(child, parent, "event_id").collect()) == Counter([("z", 2), ("y", 1)])
    assert Counter(tuple(r) for r in quality.duplicate_keys(child, "fatality_id").collect()) == Counter([("1", 2), ("2", 2)])
    values = quality.unexpected_values(child, "fatality_type", ["I", "D"])
    assert Counter(tuple(r) for r in values.collect()) == Counter([("R", 2), ("d", 1)])


def test_empty_tables_have_no_failures(rows):
    child = rows(["fatality_id", "event_id", "fatality_type", "fatality_date", "fatality_sex"], [])
    parent = rows(["event_id", "event_start_date"], [])
    report = quality.all_checks(parent, child)
    assert report.columns == ["check", "table", "column", "failures", "severity"]
    assert set(failures(report).values()) == {0} and report.count() == 9
