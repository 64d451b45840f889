"""[K9, K10, S7] The models: two staging views, two fact tables, four marts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tempestry.functions.calendar import month_key
from tempestry.operators import dedup, facts, insights, marts, quality
from tempestry.plans import staging
from tempestry.schemas import EVENTS, FATALITIES, MONTH_KEY, REVISION, Dataset
from tempestry.session import scratch_path, together
from tempestry.sources import catalog, warehouse

STG_EVENTS = "stg_events"
STG_FATALITIES = "stg_fatalities"


@dataclass(frozen=True)
class Staged:
    events: DataFrame
    fatalities: DataFrame


def staging_views(spark: SparkSession, warehouse_root: str, latest_load_wins: bool = False) -> Staged:
    """[K9] The de-duplicated tables as temporary views, computed when read.

    ``latest_load_wins`` keeps, of the rows of a key, one from the latest
    revision of its file instead of the first by value; a row loaded without a revision comes last.
    """
    order = [F.desc_nulls_last(REVISION)] if latest_load_wins else []

    def loaded(dataset: Dataset) -> DataFrame:
        # Year and month of the load would be sorted and shuffled, but never decide which values are kept.
        rows = warehouse.read_by_year(spark, f"{warehouse_root}/{dataset.name}", dataset)
        return rows.select(*dataset.columns, *([REVISION] if latest_load_wins else []))

    staged = Staged(dedup.stage_events(loaded(EVENTS), order), dedup.stage_fatalities(loaded(FATALITIES), order))
    staged.events.createOrReplaceTempView(STG_EVENTS)
    staged.fatalities.createOrReplaceTempView(STG_FATALITIES)
    return staged


def create_views(
    spark: SparkSession, events: str, fatalities: str, prefix: str = "", latest_load_wins: bool = False
) -> Staged:
    """[K9] The de-duplicated tables as views of the catalog, over tables that the catalog has.

    Unlike :func:`staging_views` they are there for other sessions and after this one.
    ``events`` and ``fatalities`` name the loaded tables (:func:`warehouse.register_table`, :func:`catalog.create_partitioned`).
    """
    return Staged(
        catalog.staging_view(spark, f"{prefix}{STG_EVENTS}", events, EVENTS, latest_load_wins),
        catalog.staging_view(spark, f"{prefix}{STG_FATALITIES}", fatalities, FATALITIES, latest_load_wins),
    )


def refreshed(spark: SparkSession, warehouse_root: str, staged_root: str, latest_load_wins: bool = False) -> Staged:
    """[W1, W2] The de-duplicated tables from files, brought up to date first; see :func:`staging.refresh`."""
    datasets = (EVENTS, FATALITIES)
    roots = {d.name: (f"{warehouse_root}/{d.name}", f"{staged_root}/{d.name}") for d in datasets}
    together(spark, *(partial(staging.refresh, spark, *roots[d.name], d, latest_load_wins) for d in datasets))
    return Staged(*(staging.read_staged(spark, roots[d.name][1], d) for d in datasets))


def rebuild(spark: SparkSession, df: DataFrame, path: str, order: str | None = None) -> DataFrame:
    """[K10, O1-O3] Replace the table at ``path`` with ``df`` and read it back.

    ``order`` names a column by which the rows are dealt to files in ranges and
    sorted within them. The footers of the files then let a filter on it skip most files and
    row groups, for one shuffle when writing.
    """
    rows = df.repartitionByRange(F.col(order)).sortWithinPartitions(order) if order else df
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rebuild_by_month(spark: SparkSession, fact: DataFrame, path: str, date: str) -> DataFrame:
    """[K10] As :func:`rebuild`, in one folder per month of ``date`` (``month_key``).

    For readers that filter facts by date. It costs a shuffle of the whole
    table, which the marts do not gain from.
    """
    keyed = fact.withColumn(MONTH_KEY, month_key(F.col(date)))
    keyed.hint("rebalance", MONTH_KEY).write.mode("overwrite").partitionBy(MONTH_KEY).parquet(path)
    return spark.read.schema(keyed.schema).parquet(path)


def build(
    spark: SparkSession,
    warehouse_root: str,
    model_root: str,
    *,
    facts_by_month: bool = False,
    facts_by_date: bool = False,
    buckets: int | None = None,
    prefix: str = "",
    fix_year_month: bool = False,
    staged_root: str | None = None,
    **options,
) -> dict[str, DataFrame]:
    """All models. The facts are written once and read by the marts, which are written too.

    The de-duplication, the one costly step, so runs once per table, and a
    mart that loses an executor starts from files. As a rule the facts are
    written by the tasks that de-duplicate, with no shuffle in
    between. All are temporary views under their names afterwards.

    ``staged_root`` keeps the staged tables there, of which only what a load
    changed is staged again. The facts can be laid out ``by_month`` in
    folders, ``by_date`` in order within and among files, or in ``buckets`` by
    event id as tables of the catalog named with ``prefix``, which the joined mart then reads without a shuffle.
    """
    if facts_by_month + facts_by_date + (buckets is not None) > 1:
        raise ValueError("choose one layout of the facts")
    staged = (
        refreshed(spark, warehouse_root, staged_root, **options)
        if staged_root
        else staging_views(spark, warehouse_root, **options)
    )
    dated = {
        "fact_events": (facts.fact_events(staged.events, fix_year_month=fix_year_month), "event_start_date"),
        "fact_fatalities": (facts.fact_fatalities(staged.fatalities), "fatality_date"),
    }

    def write_fact(name: str) -> DataFrame:
        fact, date = dated[name]
        path = f"{model_root}/{name}"
        if buckets is not None:
            return catalog.write_bucketed(spark, fact, f"{prefix}{name}", path, EVENTS.key, buckets)
        if facts_by_month:
            return rebuild_by_month(spark, fact, path, date)
        return rebuild(spark, fact, path, date if facts_by_date else None)

    events, fatalities = together(spark, *(partial(write_fact, name) for name in dated))
    summaries = {
        "fact_costliest_events": marts.costliest_events(events),
        "fact_fatalities_by_month": marts.fatalities_by_month(fatalities),
        "fact_fatalities_by_sex": marts.fatalities_by_sex(fatalities),
        "fact_fatality_type_by_event_type": marts.fatality_type_by_event_type(events, fatalities),
    }
    written = together(
        spark, *(partial(rebuild, spark, df, f"{model_root}/{name}") for name, df in summaries.items())
    )
    tables = dict(zip([*dated, *summaries], [events, fatalities, *written]))
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def read_mart(spark: SparkSession, model_root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{model_root}/{name}")


def answers(spark: SparkSession, model_root: str, year: int | None = None, k: int = 10) -> dict[str, DataFrame]:
    """[D1-D4] The questions answered from the marts, for one year or for all."""

    def mart(name: str, year_column: str) -> DataFrame:
        df = read_mart(spark, model_root, name)
        return df if year is None else df.filter(F.col(year_column) == year)

    types = mart("fact_fatality_type_by_event_type", "event_start_year")
    return {
        "most common fatality type": insights.top_fatality_type(types),
        "fatality types by event type, percent": insights.fatality_balance(types),
        "month with most fatalities": insights.peak_month(mart("fact_fatalities_by_month", "fatality_year")),
        "costliest event types": insights.top_cost(mart("fact_costliest_events", "event_start_year"), k),
        "fatalities by sex, percent": insights.sex_share(mart("fact_fatalities_by_sex", "fatality_year")),
    }


def check(spark: SparkSession, warehouse_root: str, **options) -> DataFrame:
    """The data tests' report on the staged tables.

    The tested columns of the staged rows are written to the shared folder
    once, and nulls and unlisted values are counted by that job as the rows
    pass, so they cost no scan. Keys that occur twice or have no parent are found in what was written. The
    report has one row per test and column.
    """
    staged = staging_views(spark, warehouse_root, **options)
    tables = {STG_EVENTS: staged.events, STG_FATALITIES: staged.fatalities}
    counted: dict[str, dict[str, int]] = {}

    def write(table: str) -> DataFrame:
        observation = Observation(f"tests of {table}")
        tested = tables[table].select(*quality.tested_columns(table)).observe(observation, *quality.observed(table))
        path = scratch_path(spark, table)
        tested.write.parquet(path)
        counted[table] = observation.get
        return spark.read.schema(tested.schema).parquet(path)

    written = dict(zip(tables, together(spark, *(partial(write, table) for table in tables))))
    report = quality.all_checks(written[STG_EVENTS], written[STG_FATALITIES], counted)
    return spark.createDataFrame(report.collect(), report.schema)
