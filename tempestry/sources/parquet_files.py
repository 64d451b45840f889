"""[S4, S5, K1, K2, K3] Cleaned rows as Parquet."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tempestry.schemas import LOAD_YEAR, REVISION, Dataset
from tempestry.sources import partitions


def spread(raw: DataFrame, files: int | None = None) -> DataFrame:
    """[K2] Redistribute rows evenly before they are typed and written.

    A gzip file is read by one task; this lets many tasks do the rest. By
    default Spark aims at partitions of the advisory size; ``files`` fixes
    their number.
    """
    return raw.repartition(files) if files else raw.hint("rebalance")


def write_parquet(df: DataFrame, path: str) -> None:
    """[K1] Replace ``path``; one file per partition."""
    df.write.mode("overwrite").parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """[S4, S5] Read in place, with the schema given instead of taken from a footer."""
    return spark.read.schema(schema).parquet(path)


def write_years(spark: SparkSession, df: DataFrame, path: str, years: Iterable[int]) -> None:
    """[K3] One folder per ``load_year``; ``df`` becomes the whole content of ``years``, others stay.

    A year without rows gets a folder with an empty file, which tells it from
    a year that was never written.
    """
    partitions.replace_years(spark, df, path, [LOAD_YEAR], years, mark=True)


def read_years(spark: SparkSession, path: str, dataset: Dataset, years: Iterable[int] | None = None) -> DataFrame:
    """The cleaned rows with their ``revision`` and ``load_year``, of all years or of those given.

    Only their folders are listed; a year without a folder raises ``PATH_NOT_FOUND``.
    """
    extra = [T.StructField(REVISION, T.StringType()), T.StructField(LOAD_YEAR, T.IntegerType())]
    schema = T.StructType([*dataset.schema.fields, *extra])
    if years is None:
        return read_parquet(spark, path, schema)
    folders = [f"{path}/{LOAD_YEAR}={year}" for year in sorted(set(years))]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)
