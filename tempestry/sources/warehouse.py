"""[K4-K8, S6] Loaded tables: all years, partitioned by file year and month of the date.

A table has versions (:mod:`versions`), and each load is a folder of Parquet
with the layout ``load_year=Y/month_key=yyyy-MM``. The file's year comes first
because a reload replaces the file's rows, and rows with a null date of
different years would otherwise share a partition.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempestry.functions.calendar import month_key
from tempestry.schemas import LOAD_YEAR, MONTH_KEY, REVISION, Dataset
from tempestry.sources import versions
from tempestry.sources.catalog import columns_sql, literal, quoted


def create_table(spark: SparkSession, path: str, dataset: Dataset) -> None:
    """[K4, K5] An empty table with the fixed schema; an existing one stays as it is."""
    versions.create(spark, path)


def read_table(spark: SparkSession, path: str, dataset: Dataset, at: versions.Version | None = None) -> DataFrame:
    """[S6] The newest version of the table, or ``at``; filters on ``load_year`` and ``month_key`` prune folders."""
    return versions.read(spark, path, dataset.table_schema, at)


def read_by_year(spark: SparkSession, path: str, dataset: Dataset) -> DataFrame:
    """As :func:`read_table`, for whoever sorts what a task reads; see :func:`versions.read_by_year`."""
    return versions.read_by_year(spark, path, dataset.table_schema)


def _condition(folder: str) -> str:
    """A partition folder's name as a condition on its column; Spark names the folder of null in a way of its own."""
    column, _, value = folder.partition("=")
    return f"{column} is null" if value == "__HIVE_DEFAULT_PARTITION__" else f"{column} = {value}"


def register_table(spark: SparkSession, name: str, path: str, dataset: Dataset) -> DataFrame:
    """Make the newest version known to the catalog under ``name``, read in place.

    ``name`` is a view of the published parts of the table ``<name>_loads``,
    which has a partition for each month of each load. The view is replaced
    at once, so its readers see one version or the next; to follow the table, register it again.
    """
    at = versions.current(spark, path)
    if at is None:
        raise ValueError(f"there is no table at {path}")
    loads = quoted(f"{name}_loads")
    spark.sql(
        f"create table if not exists {loads} ({columns_sql(dataset.table_schema)}, {versions.LOAD_ID} string) using parquet "
        f"partitioned by ({versions.LOAD_ID}, {LOAD_YEAR}, {MONTH_KEY}) location {literal(f'{path}/loads')}"
    )
    if at.parts:
        spark.sql(f"msck repair table {loads}")
    published = [f"({versions.LOAD_ID} = {literal(load)} and {_condition(folder)})" for load, folder in at.parts]
    listed = ", ".join(f.name for f in dataset.table_schema.fields)
    where = " or ".join(published) or "false"
    spark.sql(f"create or replace view {quoted(name)} as select {listed} from {loads} where {where}")
    return spark.table(quoted(name))


def between(df: DataFrame, dataset: Dataset, first: date, last: date) -> DataFrame:
    """Rows dated ``first`` to ``last``, both included, reading only the months in between."""
    months = F.col(MONTH_KEY).between(f"{first:%Y-%m}", f"{last:%Y-%m}")
    days = (F.col(dataset.date) >= F.lit(first)) & (F.col(dataset.date) < F.lit(last + timedelta(days=1)))
    return df.filter(months & days)


def _laid_out(cleaned: DataFrame, dataset: Dataset) -> DataFrame:
    """Columns in table order, rows grouped by partition.

    The rebalance hint gives files of even size: Spark splits a month that
    holds much of the rows over several tasks and joins small ones. Rows that
    come with their month were dealt out by it already.
    """
    tag = F.col(REVISION) if REVISION in cleaned.columns else F.lit(None).cast("string").alias(REVISION)
    columns: list[Column | str] = [*dataset.columns, tag, F.col(LOAD_YEAR).cast("int").alias(LOAD_YEAR)]
    if MONTH_KEY in cleaned.columns:
        return cleaned.select(*columns, MONTH_KEY)
    laid_out = cleaned.select(*columns, month_key(F.col(dataset.date)).alias(MONTH_KEY))
    return laid_out.hint("rebalance", LOAD_YEAR, MONTH_KEY)


def append(spark: SparkSession, cleaned: DataFrame, path: str, dataset: Dataset) -> None:
    """[K6, K7] Add the rows, by column name. Loading a year twice doubles it until staging."""
    versions.append(spark, _laid_out(cleaned, dataset), path, [LOAD_YEAR, MONTH_KEY])


def replace_years(
    spark: SparkSession, cleaned: DataFrame, path: str, dataset: Dataset, years: Iterable[int]
) -> None:
    """[K8] Make ``cleaned`` the whole content of ``years``, at once; see :func:`versions.replace_years`."""
    versions.replace_years(spark, _laid_out(cleaned, dataset), path, [LOAD_YEAR, MONTH_KEY], years)
