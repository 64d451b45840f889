"""[T1-T4, A5, J2] Data tests. They report and never stop a run.

Each report row is ``check, table, column, failures``. A failure is a key that
occurs more than once (unique), a row without value (not_null), a row whose
non-null key has no parent (relationships) or an unlisted value
(accepted_values). The ``*_keys`` and ``*_values`` functions list them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: the columns tested and the values accepted ---
NOT_NULL = {
    "stg_fatalities": ("fatality_id", "fatality_date"),
    "stg_events": ("event_id", "event_start_date"),
}
UNIQUE = {"stg_fatalities": "fatality_id", "stg_events": "event_id"}
ACCEPTED = {"fatality_type": ("I", "D"), "fatality_sex": ("M", "F")}
# --- end of fixed values ---

SEVERITY = "warn"


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """[A5] Non-null keys that occur more than once, with their number of rows."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("n > 1")


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """[J2] Non-null child keys without parent, with their number of rows.

    Counting per key first leaves one row per key for the anti-join, whatever
    the number of rows behind it.
    """
    counts = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(parent.select(key).distinct(), key, "left_anti")


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside ``accepted`` with their number of rows; null passes."""
    odd = df.filter(~F.col(column).isin(*accepted))
    return odd.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _report(failures: DataFrame, check: str, table: str, column: str, total: Column) -> DataFrame:
    return failures.agg(F.coalesce(total, F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(column).alias("column"), "failures"
    )


def unique(df: DataFrame, table: str, key: str) -> DataFrame:
    """[T1]"""
    return _report(duplicate_keys(df, key), "unique", table, key, F.count(F.lit(1)))


def _counted(df: DataFrame, table: str, counts: Mapping[tuple[str, str], Column]) -> DataFrame:
    """Failures of several tests of a table in one pass; ``counts`` by check and column."""
    names = {f"{check}:{column}": count.alias(f"{check}:{column}") for (check, column), count in counts.items()}
    failures = df.agg(*names.values()).unpivot([], [f"`{n}`" for n in names], "name", "failures")
    part = F.split("name", ":")
    return failures.select(part[0].alias("check"), F.lit(table).alias("table"), part[1].alias("column"), "failures")


def _nulls(columns: Sequence[str]) -> dict[tuple[str, str], Column]:
    return {("not_null", c): F.count_if(F.col(c).isNull()) for c in columns}


def _unlisted(accepted: Mapping[str, Sequence[str]]) -> dict[tuple[str, str], Column]:
    return {
        ("accepted_values", c): F.count_distinct(F.when(~F.col(c).isin(*values), F.col(c)))
        for c, values in accepted.items()
    }


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """[T2] All columns of a table in one pass."""
    return _counted(df, table, _nulls(columns))


def relationships(child: DataFrame, parent: DataFrame, table: str, key: str) -> DataFrame:
    """[T3]"""
    return _report(orphan_keys(child, parent, key), "relationships", table, key, F.sum("n"))


def accepted_values(df: DataFrame, table: str, accepted: Mapping[str, Sequence[str]]) -> DataFrame:
    """[T4] All columns of a table in one pass."""
    return _counted(df, table, _unlisted(accepted))


def _union(reports) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def tested_columns(table: str) -> list[str]:
    """The columns of a table that any test reads."""
    found = {UNIQUE[table], *NOT_NULL[table], "event_id", *(ACCEPTED if table == "stg_fatalities" else ())}
    return sorted(found)


def observed(table: str) -> list[Column]:
    """Counts of a table that :meth:`DataFrame.observe` can take while its rows are written: nulls, and rows of unlisted values."""
    accepted = ACCEPTED if table == "stg_fatalities" else {}
    nulls = [F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in NOT_NULL[table]]
    return nulls + [F.count_if(~F.col(c).isin(*values)).alias(f"accepted_values:{c}") for c, values in accepted.items()]


def _observed_report(df: DataFrame, table: str, counts: Mapping[str, int]) -> DataFrame:
    """The tests that :func:`observed` counted. How many different values are unlisted takes a pass, if there are any."""
    known, odd = [], {}
    for name, number in counts.items():
        check, column = name.split(":")
        if check == "accepted_values" and number:
            odd[column] = ACCEPTED[column]
        else:
            known.append((check, table, column, number))
    report = df.sparkSession.createDataFrame(known, "check string, table string, column string, failures long")
    return report.unionByName(accepted_values(df, table, odd)) if odd else report


def all_checks(
    stg_events: DataFrame, stg_fatalities: DataFrame, counts: Mapping[str, Mapping[str, int]] | None = None
) -> DataFrame:
    """The nine tests, in three passes over the fatalities and three over the events.

    Pass tables, not long plans: each pass reads its table anew. ``counts``
    has what :func:`observed` counted of each table when it was written, and saves a
    pass over each, or over those columns with values that are not listed.
    """
    tables = {"stg_events": stg_events, "stg_fatalities": stg_fatalities}
    accepted = {"stg_events": {}, "stg_fatalities": ACCEPTED}
    counted = [
        _observed_report(tables[t], t, counts[t]) if counts else _counted(tables[t], t, _nulls(columns) | _unlisted(accepted[t]))
        for t, columns in NOT_NULL.items()
    ]
    return _union(
        [unique(tables[t], t, key) for t, key in UNIQUE.items()]
        + counted
        + [relationships(stg_fatalities, stg_events, "stg_fatalities", "event_id")]
    ).withColumn("severity", F.lit(SEVERITY))
