"""[W1, W2, F1, P3, P4] One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempestry.schemas import EVENTS, FATALITIES, Dataset


def first_per_key(df: DataFrame, key: str, order_by: Sequence[Column] = ()) -> DataFrame:
    """Keep the first row of each key, and one row for all null keys together.

    Rows are ordered by ``order_by``, then by every other column, nulls first,
    so that a rerun or a retried task keeps the same row. The filter on the
    row number makes Spark cut each key to one row per map task before the
    shuffle: a key that holds a third of the table sends one row per task.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c != key]
    numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order_by, *rest)))
    return numbered.filter("_rn = 1").drop("_rn")


def stage(loaded: DataFrame, dataset: Dataset, order_by: Sequence[Column] = ()) -> DataFrame:
    """The loaded table without reload duplicates, in the dataset's column order.

    Columns that neither belong to the dataset nor order the rows are dropped
    first, so they are not shuffled.
    """
    if not order_by:
        return first_per_key(loaded.select(*dataset.columns), dataset.key)
    return first_per_key(loaded, dataset.key, order_by).select(*dataset.columns)


def stage_events(loaded: DataFrame, order_by: Sequence[Column] = ()) -> DataFrame:
    """[W1, P3]"""
    return stage(loaded, EVENTS, order_by)


def stage_fatalities(loaded: DataFrame, order_by: Sequence[Column] = ()) -> DataFrame:
    """[W2, P4]"""
    return stage(loaded, FATALITIES, order_by)
