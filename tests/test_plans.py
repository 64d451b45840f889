"""The physical plans: no Python workers, no cross joins, pruned scans, no shuffle more than needed."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tempestry import registered
from tempestry.plans import models
from tempestry.schemas import EVENTS, FATALITIES, LOAD_YEAR
from tempestry.sources import parquet_files, warehouse


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def whole_schemas(spark):
    """Let plans print long column lists in full."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(entry_module.queries()[name](spark, sf_dir))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "NestedLoop"):
        assert operator not in plan


def test_scans_read_only_the_columns_needed(spark, sf_dir):
    plan = plan_of(entry_module.queries()["fatality_type_by_event_type"](spark, sf_dir))
    schemas = sorted(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert [re.sub(r":\w+", "", s) for s in schemas] == [
        "c_custkey,c_nationkey",
        "l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_returnflag,l_linestatus,l_shipdate",
        "n_nationkey,n_name",
        "o_orderkey,o_custkey,o_orderstatus,o_orderdate,o_orderpriority",
    ]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """Large-table plans: files behind the tables, joins that may not broadcast."""
    root = str(tmp_path_factory.mktemp("tables"))
    for dataset in (EVENTS, FATALITIES):
        row = spark.createDataFrame([(None,) * len(dataset.columns)], dataset.schema).withColumn(LOAD_YEAR, F.lit(2024))
        warehouse.append(spark, row, f"{root}/{dataset.name}", dataset)
    return models.staging_views(spark, root)


def test_flagship_shuffles(spark, staged, no_broadcast):
    """One shuffle by key per table, one of the counts, two of the tiny result."""
    from tempestry.operators import facts, marts

    plan = plan_of(marts.fatality_type_by_event_type(facts.fact_events(staged.events), facts.fact_fatalities(staged.fatalities)))
    shuffles = re.findall(r"Exchange (hash|range)partitioning\((\w+)#", plan)
    assert sorted(shuffles) == [
        ("hash", "event_id"), ("hash", "event_id"), ("hash", "event_start_year"), ("hash", "fatality_id"), ("range", "event_type"),
    ]
    assert "SortMergeJoin [event_id" in plan
    assert plan.count("WindowGroupLimit") == 4


def test_staging_leaves_load_columns_behind(spark, staged):
    for df in (staged.events, staged.fatalities):
        # A scan always shows the columns of its folders; nothing above it has them.
        above = [line for line in plan_of(df).splitlines() if "FileScan" not in line]
        assert len(above) > 5 and not any(c in line for line in above for c in ("load_year#", "month_key#", "load_id#"))


def test_marts_read_few_columns_of_a_written_fact(spark, staged, tmp_path):
    from tempestry.operators import facts, marts

    events = models.rebuild(spark, facts.fact_events(staged.events), str(tmp_path / "f"))
    plan = plan_of(marts.costliest_events(events))
    assert "ReadSchema: struct<event_type:string,event_start_year:bigint,damage_property:bigint,damage_crops:bigint>" in plan
    assert plan.count("Exchange") == 1


def test_facts_by_month_can_be_pruned(spark, tmp_path):
    from tempestry.operators import facts
    from tempestry.schemas import FACT_EVENT_COLUMNS

    row = {"event_id": "1", "event_start_date": datetime(2024, 5, 1)}
    fact = facts.fact_events(spark.createDataFrame([tuple(row.get(c) for c in EVENTS.columns)], EVENTS.schema))
    events = models.rebuild_by_month(spark, fact, str(tmp_path / "f"), "event_start_date")
    assert events.columns == [*FACT_EVENT_COLUMNS, "month_key"]
    month = events.filter("month_key = '2024-05'")
    assert re.search(r"PartitionFilters: \[.*month_key#\d+ = 2024-05", plan_of(month))
    assert month.count() == 1


def test_duplicate_check_of_staged_rows_needs_no_second_shuffle(staged):
    from tempestry.operators import quality

    plan = plan_of(quality.duplicate_keys(staged.events, "event_id"))
    assert plan.count("Exchange") == 1


def test_only_the_folders_of_the_years_are_listed(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = [("1", 2023), ("2", 2024), ("3", 2025)]
    spark.createDataFrame(rows, "fatality_id string, load_year int").write.partitionBy("load_year").parquet(path)
    read = parquet_files.read_years(spark, path, FATALITIES, [2025, 2024, 2024])
    assert {f.split("load_year=")[1][:4] for f in read.inputFiles()} == {"2024", "2025"}
    assert sorted((r.fatality_id, r.load_year) for r in read.collect()) == [("2", 2024), ("3", 2025)]


def test_checks_read_the_fatalities_three_times_and_few_columns(spark, staged, tmp_path):
    from tempestry.operators import quality

    paths = {}
    for name, df in (("stg_events", staged.events), ("stg_fatalities", staged.fatalities)):
        paths[name] = models.rebuild(spark, df.select(*quality.tested_columns(name)), str(tmp_path / name))
    plan = plan_of(quality.all_checks(paths["stg_events"], paths["stg_fatalities"]))
    assert plan.count(f"{tmp_path}/stg_fatalities") <= 3 and plan.count(f"{tmp_path}/stg_events") <= 3
    assert len(paths["stg_fatalities"].columns) == 5 and len(paths["stg_events"].columns) == 2


def test_orphans_are_counted_before_the_join(spark, staged, no_broadcast):
    """So a parent key with a third of the child rows is one row in the join."""
    from tempestry.operators import quality

    plan = plan_of(quality.orphan_keys(staged.fatalities, staged.events, "event_id"))
    join = plan.index("LeftAnti")
    assert plan.index("HashAggregate(keys=[event_id") > join
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(shuffles) == ["event_id", "event_id", "fatality_id"]


def test_rows_kept_in_a_lake_are_dealt_out_before_they_are_typed(spark, sf_dir, tmp_path):
    """One shuffle, which spreads the typing of large files."""
    from tempestry import driver_tables
    from tempestry.plans import jobs

    driver_tables.write_year_files(spark, sf_dir, "fatalities", str(tmp_path))
    years = driver_tables.years_of(spark, sf_dir, "fatalities")
    cleaned = jobs.cleaned_years(spark, str(tmp_path), "fatalities", years, layout=driver_tables.FOLDER_LAYOUT)
    plan = plan_of(cleaned)
    assert re.findall(r"Exchange hashpartitioning\((\w+)#\d+, (\w+)#", plan) == [("load_year", "_piece")]
    assert plan.index("gettimestamp") < plan.index("_piece")


def test_a_backfill_shuffles_its_rows_once(spark, sf_dir, tmp_path):
    from tempestry import driver_tables
    from tempestry.plans import jobs

    driver_tables.write_year_files(spark, sf_dir, "fatalities", str(tmp_path))
    years = driver_tables.years_of(spark, sf_dir, "fatalities")
    layout = driver_tables.FOLDER_LAYOUT
    cleaned = jobs.cleaned_years(spark, str(tmp_path), "fatalities", years, layout=layout, by_month=True)
    assert plan_of(warehouse._laid_out(cleaned, FATALITIES)).count("Exchange") == 1
