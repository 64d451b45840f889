"""The queries of ``__spark_entry__``: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempestry import driver_tables
from tempestry.functions import parsing
from tempestry.operators import clean, dedup, facts, insights, marts, quality
from tempestry.plans import jobs, models, staging
from tempestry.schemas import DATASETS, EVENTS, FATALITIES, LOAD_YEAR, MONTH_KEY, REVISION
from tempestry.session import scratch_path, together
from tempestry.sources import catalog, csv_files, parquet_files, warehouse

Query = Callable[[SparkSession, str], DataFrame]

# --- inputs shared by the queries; each is a lazy DataFrame ---


def _clean_events(spark: SparkSession, sf_dir: str, with_year: bool = False) -> DataFrame:
    return clean.clean_events(driver_tables.raw_events(spark, sf_dir, with_year))


def _clean_fatalities(spark: SparkSession, sf_dir: str, with_year: bool = False) -> DataFrame:
    return clean.clean_fatalities(driver_tables.raw_fatalities(spark, sf_dir, with_year))


def _cleaned(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return clean.clean(driver_tables.raw(spark, sf_dir, dataset, with_year=True), DATASETS[dataset])


def _stg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.stage_events(_clean_events(spark, sf_dir))


def _stg_fatalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.stage_fatalities(_clean_fatalities(spark, sf_dir))


def _fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_events(_stg_events(spark, sf_dir))


def _fact_fatalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_fatalities(_stg_fatalities(spark, sf_dir))


def _costliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.costliest_events(_fact_events(spark, sf_dir))


def _by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fatalities_by_month(_fact_fatalities(spark, sf_dir))


def _by_sex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fatalities_by_sex(_fact_fatalities(spark, sf_dir))


def fatality_type_by_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fatality_type_by_event_type(_fact_events(spark, sf_dir), _fact_fatalities(spark, sf_dir))


# --- sources and sinks ---


def _csv_scan(dataset: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, f"csv_{dataset}")
        driver_tables.write_csv(spark, sf_dir, dataset, path)
        return csv_files.read_csv(spark, path, DATASETS[dataset])

    return query


def _year_select(revision: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, "year_files")
        driver_tables.write_year_files(spark, sf_dir, "events", root)
        years = driver_tables.years_of(spark, sf_dir, "events")
        files = csv_files.year_files(spark, root, EVENTS, years, driver_tables.FOLDER_LAYOUT, revision)
        rows = csv_files.read_year_files(spark, files, EVENTS)
        return clean.clean_events(rows).withColumn(LOAD_YEAR, F.col(LOAD_YEAR).cast("bigint"))

    return query


def _csv_rejects(multiline: bool) -> Query:
    """Rows that do not fit; a quote that is never closed takes its line, or the rest of its file."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folders = driver_tables.write_broken_csv(spark, sf_dir, scratch_path(spark, "broken_csv"))
        files = csv_files.csv_rejects(spark, folders, multiline=multiline)
        return files.agg(F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows"))

    return query


def _parquet_roundtrip(dataset: str, files_per_core: int | None = None) -> Query:
    """Files of about equal size, or a fixed number of them, here one that grows with the cluster."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = DATASETS[dataset]
        path = scratch_path(spark, f"parquet_{dataset}")
        files = files_per_core and files_per_core * spark.sparkContext.defaultParallelism
        raw = parquet_files.spread(driver_tables.raw(spark, sf_dir, dataset), files=files)
        parquet_files.write_parquet(clean.clean(raw, spec), path)
        return parquet_files.read_parquet(spark, path, spec.schema)

    return query


def _loaded(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    table = warehouse.read_table(spark, path, DATASETS[dataset])
    return table.withColumn(LOAD_YEAR, F.col(LOAD_YEAR).cast("bigint"))


def _load_append(dataset: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, f"append_{dataset}")
        for _ in range(2):
            warehouse.append(spark, _cleaned(spark, sf_dir, dataset), path, DATASETS[dataset])
        return _loaded(spark, path, dataset)

    return query


def _load_replace_year(dataset: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, f"replace_{dataset}")
        years = driver_tables.years_of(spark, sf_dir, dataset)
        for _ in range(2):
            warehouse.replace_years(spark, _cleaned(spark, sf_dir, dataset), path, DATASETS[dataset], years)
        return _loaded(spark, path, dataset)

    return query


def _load_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly files straight into a loaded table, the first revision of each year."""
    root = scratch_path(spark, "from_files")
    driver_tables.write_year_files(spark, sf_dir, "events", f"{root}/files")
    years = driver_tables.years_of(spark, sf_dir, "events")
    layout = driver_tables.FOLDER_LAYOUT
    cleaned = jobs.cleaned_years(spark, f"{root}/files", "events", years, layout=layout, revision="first", by_month=True)
    warehouse.replace_years(spark, cleaned, f"{root}/events", EVENTS, years)
    return _loaded(spark, f"{root}/events", "events")


def _table_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "by_month")
    warehouse.append(spark, _cleaned(spark, sf_dir, "fatalities"), path, FATALITIES)
    table = warehouse.read_table(spark, path, FATALITIES)
    return table.groupBy(MONTH_KEY).agg(F.count(F.lit(1)).alias("n"), F.max("fatality_date").alias("last_date"))


def _table_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of dates with rows before and after it."""
    path = scratch_path(spark, "between")
    warehouse.append(spark, _cleaned(spark, sf_dir, "fatalities"), path, FATALITIES)
    table = warehouse.read_table(spark, path, FATALITIES)
    return warehouse.between(table, FATALITIES, date(1996, 2, 10), date(1997, 11, 5)).drop(LOAD_YEAR)


def _external_years(spark: SparkSession, sf_dir: str, dataset: str) -> dict[int, str]:
    """External tables over the cleaned folders of all years, by year."""
    root = scratch_path(spark, f"external_{dataset}")
    years = driver_tables.years_of(spark, sf_dir, dataset)
    parquet_files.write_years(spark, _cleaned(spark, sf_dir, dataset), root, years)
    names = {year: f"{dataset}_{year}_{root.rpartition('-')[2]}" for year in years}
    for year, name in names.items():
        catalog.external_table(spark, name, f"{root}/{LOAD_YEAR}={year}")
    return names


def _external_table(dataset: str) -> Query:
    """Every year's folder read in place as a table of its own."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        names = _external_years(spark, sf_dir, dataset)
        return reduce(
            DataFrame.unionByName,
            (spark.table(name).withColumn(LOAD_YEAR, F.lit(year).cast("bigint")) for year, name in names.items()),
        )

    return query


def _load_sql(dataset: str) -> Query:
    """External tables inserted by SQL into a partitioned one, a year after the other, the first one twice.

    The columns come in another order than the table's. At the end the last year is replaced by itself.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        names, spec = _external_years(spark, sf_dir, dataset), DATASETS[dataset]
        path = scratch_path(spark, f"sql_{dataset}")
        target = f"loaded_{dataset}_{path.rpartition('-')[2]}"
        catalog.create_partitioned(spark, target, spec, path)
        turned = {year: f"turned_{name}" for year, name in names.items()}
        for year, name in names.items():
            table = spark.table(name)
            table.select(F.lit("x").alias("further"), *reversed(table.columns)).createOrReplaceTempView(turned[year])
            catalog.insert(spark, turned[year], target, spec, year)
        first, last = min(names), max(names)
        catalog.insert(spark, turned[first], target, spec, first)
        catalog.replace_year(spark, turned[last], target, spec, last)
        return spark.table(target).withColumn(LOAD_YEAR, F.col(LOAD_YEAR).cast("bigint"))

    return query


def _mart_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mart")
    models.rebuild(spark, _costliest(spark, sf_dir), path)
    return models.rebuild(spark, _costliest(spark, sf_dir), path)


def _mart_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined mart out of facts that are dealt into buckets by event id."""
    root = scratch_path(spark, "bucketed")
    prefix = f"b{root.rpartition('-')[2]}_"
    for name, fact in (("events", _fact_events(spark, sf_dir)), ("fatalities", _fact_fatalities(spark, sf_dir))):
        catalog.write_bucketed(spark, fact, f"{prefix}{name}", f"{root}/{name}", "event_id", 16)
    return marts.fatality_type_by_event_type(spark.table(f"{prefix}events"), spark.table(f"{prefix}fatalities"))


def _facts_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of dates out of facts whose files are in the order of the date."""
    fact = models.rebuild(spark, _fact_events(spark, sf_dir), scratch_path(spark, "by_date"), "event_start_date")
    start = F.col("event_start_date")
    return fact.filter((start >= F.lit(datetime(2096, 2, 10))) & (start < F.lit(datetime(2097, 11, 6))))


def _stg_incremental(dataset: str) -> Query:
    """Staged after each of three loads: some rows of all years, then all rows of the first years, then of the others."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, spec = scratch_path(spark, f"incremental_{dataset}"), DATASETS[dataset]
        loaded, staged = f"{root}/loaded", f"{root}/staged"
        rows = _cleaned(spark, sf_dir, dataset)
        years = driver_tables.years_of(spark, sf_dir, dataset)
        some = rows.filter(F.pmod(F.xxhash64(spec.key), F.lit(3)) != 0)
        for load, of in ((some, years), (rows, years[:3]), (rows, years[3:])):
            warehouse.replace_years(spark, load, loaded, spec, of)
            staging.refresh(spark, loaded, staged, spec)
        return staging.read_staged(spark, staged, spec)

    return query


def _stg_view(dataset: str) -> Query:
    """A view of the catalog over the registered loads of all years."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, spec = scratch_path(spark, f"view_{dataset}"), DATASETS[dataset]
        name = f"loaded_{path.rpartition('-')[2]}"
        warehouse.append(spark, _cleaned(spark, sf_dir, dataset), path, spec)
        warehouse.register_table(spark, name, path, spec)
        return catalog.staging_view(spark, f"stg_{name}", name, spec)

    return query


def _yearly_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly files of both datasets through every job, down to the joined mart."""
    root = scratch_path(spark, "backfill")
    years = {dataset: driver_tables.years_of(spark, sf_dir, dataset) for dataset in DATASETS}

    def ingest(dataset: str) -> None:
        files = f"{root}/files/{dataset}"
        driver_tables.write_year_files(spark, sf_dir, dataset, files)
        layout = driver_tables.FOLDER_LAYOUT
        jobs.ingest(
            spark, files, f"{root}/lake", years[dataset], layout=layout, datasets=[dataset], revision="first"
        )

    together(spark, *(partial(ingest, dataset) for dataset in DATASETS))
    # A year for which one of the datasets has no file was ingested for the other only.
    def load(dataset: str) -> None:
        jobs.load(spark, f"{root}/lake", f"{root}/tables", years[dataset], datasets=[dataset])

    together(spark, *(partial(load, dataset) for dataset in DATASETS))
    return models.build(spark, f"{root}/tables", f"{root}/models")["fact_fatality_type_by_event_type"]


# --- cleaning ---


def _parse_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = driver_tables.raw_events(spark, sf_dir)
    return raw.select(
        F.col("EVENT_ID").alias("event_id"),
        F.col("SOURCE").alias("source"),
        parsing.damage_dollars(F.col("DAMAGE_PROPERTY")).alias("damage_property"),
        parsing.damage_is_bad(F.col("DAMAGE_PROPERTY")).alias("damage_property_bad"),
        parsing.damage_dollars(F.col("DAMAGE_CROPS")).alias("damage_crops"),
        parsing.damage_is_bad(F.col("DAMAGE_CROPS")).alias("damage_crops_bad"),
    )


def _damage_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.damage_rejects(driver_tables.raw_events(spark, sf_dir))


def _clean_events_own_century(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = driver_tables.raw_events(spark, sf_dir, with_year=True)
    return clean.clean_events(raw, century_from=LOAD_YEAR).drop(LOAD_YEAR)


def _clean_fatalities_month_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_fatalities(driver_tables.raw_fatalities(spark, sf_dir), date_format="MM/dd/yyyy HH:mm:ss")


# --- staging and facts ---


def _latest_load(dataset: str) -> Query:
    """Two loads of the same years, the second with other values; staging keeps its rows."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, f"latest_{dataset}")
        for name, spec in DATASETS.items():
            warehouse.create_table(spark, f"{root}/{name}", spec)
        rows = driver_tables.raw(spark, sf_dir, dataset, with_year=True)
        for revision, load in (("c20250101", rows), ("c20250201", driver_tables.correction(rows, dataset))):
            cleaned = clean.clean(load.withColumn(REVISION, F.lit(revision)), DATASETS[dataset])
            warehouse.append(spark, cleaned, f"{root}/{dataset}", DATASETS[dataset])
        staged = models.staging_views(spark, root, latest_load_wins=True)
        return {"events": staged.events, "fatalities": staged.fatalities}[dataset]

    return query


def _cell_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = clean.cell_rejects(driver_tables.raw_events(spark, sf_dir), EVENTS)
    return events.unionByName(clean.cell_rejects(driver_tables.raw_fatalities(spark, sf_dir), FATALITIES))


def _catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "catalog's")
    name = f"catalog_{path.rpartition('-')[2]}"
    warehouse.append(spark, _cleaned(spark, sf_dir, "fatalities"), path, FATALITIES)
    table = warehouse.register_table(spark, name, path, FATALITIES)
    return table.groupBy(F.col(LOAD_YEAR).cast("bigint").alias(LOAD_YEAR)).agg(F.count(F.lit(1)).alias("n"))


def _fact_events_start_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_events(_stg_events(spark, sf_dir), fix_year_month=True)


# --- data tests; "loaded" is the table before de-duplication ---


def _dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = quality.unique(_clean_events(spark, sf_dir), "loaded_events", "event_id")
    return (
        loaded.unionByName(quality.unique(_clean_fatalities(spark, sf_dir), "loaded_fatalities", "fatality_id"))
        .unionByName(quality.unique(_stg_events(spark, sf_dir), "stg_events", "event_id"))
        .unionByName(quality.unique(_stg_fatalities(spark, sf_dir), "stg_fatalities", "fatality_id"))
    )


def _dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = quality.not_null(_stg_events(spark, sf_dir), "stg_events", quality.NOT_NULL["stg_events"])
    return events.unionByName(
        quality.not_null(_stg_fatalities(spark, sf_dir), "stg_fatalities", quality.NOT_NULL["stg_fatalities"])
    )


def _dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.relationships(
        _stg_fatalities(spark, sf_dir), _stg_events(spark, sf_dir), "stg_fatalities", "event_id"
    )


def _dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_values(_stg_fatalities(spark, sf_dir), "stg_fatalities", quality.ACCEPTED)


def _dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(_clean_events(spark, sf_dir), "event_id")


def _dq_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphan_keys(_stg_fatalities(spark, sf_dir), _stg_events(spark, sf_dir), "event_id")


def _dq_unexpected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unexpected_values(
        _stg_fatalities(spark, sf_dir), "fatality_type", quality.ACCEPTED["fatality_type"]
    )


def _dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "report")

    def load(dataset: str) -> None:
        warehouse.append(spark, _cleaned(spark, sf_dir, dataset), f"{root}/{dataset}", DATASETS[dataset])

    together(spark, *(partial(load, dataset) for dataset in DATASETS))
    return models.check(spark, root)


QUERIES: dict[str, Query] = {
    "csv_scan": _csv_scan("events"),
    "csv_scan_fatalities": _csv_scan("fatalities"),
    "csv_rejects": _csv_rejects(multiline=False),
    "csv_rejects_multiline": _csv_rejects(multiline=True),
    "year_select": _year_select("first"),
    "year_select_latest": _year_select("latest"),
    "parse_damage": _parse_damage,
    "damage_rejects": _damage_rejects,
    "cell_rejects": _cell_rejects,
    "clean_events": _clean_events,
    "clean_events_own_century": _clean_events_own_century,
    "clean_fatalities": _clean_fatalities,
    "clean_fatalities_month_first": _clean_fatalities_month_first,
    "parquet_roundtrip": _parquet_roundtrip("events", files_per_core=1),
    "parquet_roundtrip_fatalities": _parquet_roundtrip("fatalities"),
    "load_append": _load_append("events"),
    "load_append_fatalities": _load_append("fatalities"),
    "load_replace_year": _load_replace_year("events"),
    "load_replace_year_fatalities": _load_replace_year("fatalities"),
    "load_from_files": _load_from_files,
    "table_by_month": _table_by_month,
    "table_between": _table_between,
    "catalog_table": _catalog_table,
    "external_table": _external_table("events"),
    "external_table_fatalities": _external_table("fatalities"),
    "load_sql": _load_sql("events"),
    "load_sql_fatalities": _load_sql("fatalities"),
    "stg_events": _stg_events,
    "stg_events_latest_load": _latest_load("events"),
    "stg_fatalities_latest_load": _latest_load("fatalities"),
    "stg_fatalities": _stg_fatalities,
    "fact_events": _fact_events,
    "fact_events_start_month": _fact_events_start_month,
    "fact_fatalities": _fact_fatalities,
    "costliest_events": _costliest,
    "fatalities_by_month": _by_month,
    "fatalities_by_sex": _by_sex,
    "fatality_type_by_event_type": fatality_type_by_event_type,
    "mart_rebuild": _mart_rebuild,
    "mart_bucketed": _mart_bucketed,
    "facts_by_date": _facts_by_date,
    "stg_events_incremental": _stg_incremental("events"),
    "stg_fatalities_incremental": _stg_incremental("fatalities"),
    "stg_events_view": _stg_view("events"),
    "stg_fatalities_view": _stg_view("fatalities"),
    "yearly_backfill": _yearly_backfill,
    "top_fatality_type": lambda spark, sf_dir: insights.top_fatality_type(fatality_type_by_event_type(spark, sf_dir)),
    "fatality_balance": lambda spark, sf_dir: insights.fatality_balance(fatality_type_by_event_type(spark, sf_dir)),
    "peak_month": lambda spark, sf_dir: insights.peak_month(_by_month(spark, sf_dir)),
    "top_cost": lambda spark, sf_dir: insights.top_cost(_costliest(spark, sf_dir)),
    "cost_rank": lambda spark, sf_dir: insights.cost_rank(_costliest(spark, sf_dir)),
    "sex_share": lambda spark, sf_dir: insights.sex_share(_by_sex(spark, sf_dir)),
    "dq_unique": _dq_unique,
    "dq_not_null": _dq_not_null,
    "dq_relationships": _dq_relationships,
    "dq_accepted_values": _dq_accepted_values,
    "dq_duplicate_keys": _dq_duplicate_keys,
    "dq_orphan_keys": _dq_orphan_keys,
    "dq_unexpected_values": _dq_unexpected_values,
    "dq_report": _dq_report,
}
