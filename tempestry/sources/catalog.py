"""[K4-K7, K9, K10, S4, S5] The yearly loads as SQL over tables of the catalog, staging views, and bucketed facts.

Tables of :mod:`warehouse` are paths with versions; these are for users who
work in SQL with names. A year's cleaned folder becomes an external table, read
in place with the types its files declare, and its rows are inserted into a
table partitioned by the file's year and the month of the date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tempestry.schemas import LOAD_YEAR, MONTH_KEY, REVISION, Dataset


def quoted(name: str) -> str:
    """A table name with its parts in backticks."""
    return ".".join(f"`{part}`" for part in name.split("."))


def literal(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def columns_sql(schema: T.StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def external_table(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """[S4, S5] A table over the Parquet files of ``folder``, which stay where they are.

    No column is named: they come from the files' footers. Dropping the table leaves the files.
    """
    spark.sql(f"create table if not exists {quoted(name)} using parquet location {literal(folder)}")
    return spark.table(quoted(name))


def create_partitioned(spark: SparkSession, name: str, dataset: Dataset, folder: str | None = None) -> None:
    """[K4, K5] The loaded table with its fixed schema, by year of the file and month; an existing one stays as it is."""
    place = f" location {literal(folder)}" if folder else ""
    spark.sql(
        f"create table if not exists {quoted(name)} ({columns_sql(dataset.table_schema)}) using parquet "
        f"partitioned by ({LOAD_YEAR}, {MONTH_KEY}){place}"
    )


def _rows(spark: SparkSession, source: str, dataset: Dataset, year: int | None) -> str:
    """A select of the table's columns from ``source``, in the order of the source.

    A source without year takes ``year``, one without revision has none; the month comes from the date.
    """
    have = spark.table(quoted(source)).columns
    names = [c for c in have if c in dataset.columns or c == REVISION]
    missing = sorted(set(dataset.columns) - set(names))
    if missing:
        raise ValueError(f"{source} has no column {', '.join(missing)}")
    parts = [quoted(c) for c in names]
    if REVISION not in names:
        parts.append(f"cast(null as string) as {REVISION}")
    if year is not None:
        parts.append(f"{int(year)} as {LOAD_YEAR}")
    elif LOAD_YEAR in have:
        parts.append(f"cast({LOAD_YEAR} as int) as {LOAD_YEAR}")
    else:
        raise ValueError(f"{source} has no {LOAD_YEAR}; name the year")
    parts.append(f"date_format({quoted(dataset.date)}, 'yyyy-MM') as {MONTH_KEY}")
    return f"select /*+ rebalance({LOAD_YEAR}, {MONTH_KEY}) */ {', '.join(parts)} from {quoted(source)}"


def insert(spark: SparkSession, source: str, target: str, dataset: Dataset, year: int | None = None) -> None:
    """[K6, K7] Add the rows of table or view ``source`` to ``target``.

    Columns are matched by name, so their order in the source does not matter,
    and further ones are left out; partitions follow from the rows. Inserting
    a year twice doubles it until staging.
    """
    spark.sql(f"insert into {quoted(target)} by name {_rows(spark, source, dataset, year)}")


def replace_year(spark: SparkSession, source: str, target: str, dataset: Dataset, year: int) -> None:
    """[K8] Make the rows of ``source`` the whole content of ``year`` in ``target``: all its months, also those without rows.

    A job that fails while it commits is to be run again; :mod:`versions` has loads that change a year at once.
    """
    columns = [f.name for f in dataset.table_schema.fields if f.name != LOAD_YEAR]
    spark.sql(
        f"insert overwrite {quoted(target)} partition ({LOAD_YEAR} = {int(year)}, {MONTH_KEY}) "
        f"select {', '.join(map(quoted, columns))} from ({_rows(spark, source, dataset, year)})"
    )


def staging_view(spark: SparkSession, name: str, source: str, dataset: Dataset, latest_load_wins: bool = False) -> DataFrame:
    """[K9] A view of the catalog with one row per key of ``source``, for every session that shares the catalog.

    It is computed when it is read, and equals :func:`dedup.stage`. ``source`` is a table or view of the catalog.
    """
    order = [f"{REVISION} desc nulls last"] if latest_load_wins else []
    # The revision takes part in no other way, so that rows equal but for it are one.
    order += [f"{quoted(c)} asc nulls first" for c in dataset.columns if c != dataset.key]
    listed = ", ".join(map(quoted, dataset.columns))
    spark.sql(
        f"create or replace view {quoted(name)} as select {listed} from (select *, row_number() over "
        f"(partition by {quoted(dataset.key)} order by {', '.join(order)}) as _rn from {quoted(source)}) where _rn = 1"
    )
    return spark.table(quoted(name))


def write_bucketed(spark: SparkSession, df: DataFrame, name: str, path: str, key: str, buckets: int, dealt: bool = False) -> DataFrame:
    """[K10] Replace table ``name``, whose files at ``path`` are dealt into buckets by ``key`` and sorted by it.

    Joins and aggregates of such tables by ``key`` need no shuffle if they have
    equally many buckets. ``dealt`` says that the rows come partitioned by ``key`` already, as those of staging
    do; others are shuffled once here. A key with very many rows is one
    bucket, which Spark does not split, so take this for facts that are read often and whose keys are even.
    """
    spark.sql(f"drop table if exists {quoted(name)}")
    rows = df if dealt else df.repartition(buckets, key)
    rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(quoted(name))
    return spark.table(quoted(name))


def attach_bucketed(spark: SparkSession, name: str, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """[K10] Make files of :func:`write_bucketed` known to a catalog that does not have them, without reading them."""
    spark.sql(
        f"create table if not exists {quoted(name)} ({columns_sql(schema)}) using parquet "
        f"clustered by ({quoted(key)}) sorted by ({quoted(key)}) into {buckets} buckets location {literal(path)}"
    )
    return spark.table(quoted(name))
