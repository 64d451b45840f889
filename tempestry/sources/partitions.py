"""Replacing whole years of a table stored in partition folders."""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempestry.schemas import LOAD_YEAR
from tempestry.session import together


def _first_files(spark: SparkSession, path: str, years: list[int]) -> dict[str, str]:
    """The first file of each partition folder of ``years``: a listing, with one entry per folder."""
    folders = f"{path}/{LOAD_YEAR}={{{','.join(map(str, years))}}}"
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    folder = F.regexp_extract("path", f"({LOAD_YEAR}=.*)/", 1)
    firsts = listing.groupBy(folder.alias("folder")).agg(F.min("path").alias("file"))
    return {row.folder: row.file for row in firsts.collect()}


def _write_empty(spark: SparkSession, schema: T.StructType, folders: list[str]) -> None:
    """An empty file in each folder, several folders at a time."""
    empty = spark.createDataFrame([], schema)
    if folders:
        together(spark, *(partial(empty.write.mode("overwrite").parquet, folder) for folder in folders))


def _with_rows(spark: SparkSession, schema: T.StructType, folders: list[str]) -> set[str]:
    """Those of ``folders`` that hold rows; counts come from the files' footers."""
    if not folders:
        return set()
    files = spark.read.schema(schema).parquet(*folders).select(F.col("_metadata.file_path").alias("path"))
    found = files.groupBy(F.regexp_extract("path", f"({LOAD_YEAR}=.*)/", 1).alias("folder")).count().collect()
    return {row.folder for row in found}


def replace_years(
    spark: SparkSession, rows: DataFrame, path: str, partition_by: list[str], years: Iterable[int], mark: bool = False
) -> None:
    """Make ``rows`` the whole content of ``years`` in the table at ``path``; other years stay.

    ``partition_by`` begins with ``load_year``. All years are written by one
    job, which swaps in the folders it has rows for when it commits: a job that
    fails before its commit leaves the old rows, one that fails later is to be run
    again. A folder that still holds its old first
    file after that got no rows, and if it has any it is emptied. Listing the folders of these
    years before and after (13 per year at most) tells, so no row is read or
    computed a second time. Running it again gives the same table. ``mark``
    leaves an empty folder for a year that has no rows, with ``load_year`` as
    the only partition column.
    """
    years = sorted(set(years))
    before = _first_files(spark, path, years)
    (
        rows.filter(F.col(LOAD_YEAR).isin(*years))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    after = _first_files(spark, path, years) if before or mark else {}
    schema = rows.drop(*partition_by).schema
    old = [f"{path}/{folder}" for folder, file in before.items() if after.get(folder) == file]
    stale = _with_rows(spark, schema, old)
    folders = [folder for folder in old if folder.removeprefix(f"{path}/") in stale]
    if mark:
        folders += [f"{path}/{LOAD_YEAR}={year}" for year in years if f"{LOAD_YEAR}={year}" not in after]
    _write_empty(spark, schema, folders)
