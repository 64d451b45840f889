"""Incremental staging, views of the catalog, bucketed and ordered facts, and tests counted while writing."""

import random
import re
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tempestry.operators import dedup, facts, marts, quality
from tempestry.plans import models, staging
from tempestry.schemas import EVENTS, FATALITIES, LOAD_YEAR, REVISION
from tempestry.sources import catalog, versions, warehouse


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def without_broadcast(spark):
    """Joins as of large tables, and Bloom filters at run time also for small ones."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.maxMetadataStringLength": "10000",
    }
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def loaded(spark, rows):
    """Fatalities out of (id, age, year, revision)."""
    df = spark.createDataFrame(rows, f"fatality_id string, fatality_age long, {LOAD_YEAR} int, {REVISION} string")
    types = {f.name: f.dataType for f in FATALITIES.schema.fields}
    date = F.make_timestamp(F.col(LOAD_YEAR), F.lit(3), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("fatality_date")
    others = [c for c in FATALITIES.columns if c not in (*df.columns, "fatality_date")]
    return df.select("*", date, *(F.lit(None).cast(types[c]).alias(c) for c in others))


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("latest", [False, True])
def test_refresh_equals_staging_everything(spark, tmp_path, latest):
    """Random loads whose keys lie in several years, the null key among them."""
    rng = random.Random(7 + latest)
    tables, staged = str(tmp_path / "loaded"), str(tmp_path / "staged")
    order = [F.desc_nulls_last(REVISION)] if latest else []
    for load in range(6):
        years = rng.sample([2020, 2021, 2022, 2023], rng.randint(1, 2))
        rows = [
            (rng.choice([None, "x", *(f"k{i}" for i in range(12))]), rng.randint(0, 3), year, rng.choice([None, f"c{load}"]))
            for year in years
            for _ in range(rng.randint(0, 8))
        ]
        if load == 3:
            warehouse.append(spark, loaded(spark, rows), tables, FATALITIES)
        else:
            warehouse.replace_years(spark, loaded(spark, rows), tables, FATALITIES, years)
        if load != 1:  # one refresh for two loads
            staging.refresh(spark, tables, staged, FATALITIES, latest)
            whole = dedup.stage(warehouse.read_table(spark, tables, FATALITIES), FATALITIES, order)
            assert content(staging.read_staged(spark, staged, FATALITIES)) == content(whole)
    assert staging.refresh(spark, tables, staged, FATALITIES, latest) == []
    staging.refresh(spark, tables, staged, FATALITIES, not latest)
    order = [] if latest else [F.desc_nulls_last(REVISION)]
    whole = dedup.stage(warehouse.read_table(spark, tables, FATALITIES), FATALITIES, order)
    assert content(staging.read_staged(spark, staged, FATALITIES)) == content(whole)


def test_refresh_touches_the_years_of_a_load_and_those_that_share_its_keys(spark, tmp_path):
    tables, staged = str(tmp_path / "loaded"), str(tmp_path / "staged")
    rows = [(f"{year}-{i}", 1, year, None) for year in range(2015, 2025) for i in range(3)]
    warehouse.append(spark, loaded(spark, rows), tables, FATALITIES)
    assert len(staging.refresh(spark, tables, staged, FATALITIES)) == 10
    before = versions.current(spark, staged).parts
    new = [("2024-0", 2, 2024, None), ("2024-9", 2, 2024, None), ("2017-1", 0, 2024, None)]
    warehouse.replace_years(spark, loaded(spark, new), tables, FATALITIES, [2024])
    assert staging.refresh(spark, tables, staged, FATALITIES) == ["load_year=2017", "load_year=2024"]
    kept = {p for p in before if p[1] not in ("load_year=2017", "load_year=2024")}
    assert len(kept) == 8 and kept < set(versions.current(spark, staged).parts)
    found = {r.fatality_id: r.fatality_age for r in staging.read_staged(spark, staged, FATALITIES).collect()}
    assert found["2017-1"] == 1 and found["2024-9"] == 2 and "2024-1" not in found and len(found) == 29


def test_a_load_that_shares_keys_with_all_years_is_staged_in_one_pass(spark, tmp_path, monkeypatch):
    tables, staged = str(tmp_path / "loaded"), str(tmp_path / "staged")
    rows = [(f"k{i}", (i + year) % 4, year, None) for year in range(2020, 2024) for i in range(400)]
    warehouse.append(spark, loaded(spark, rows), tables, FATALITIES)
    staging.refresh(spark, tables, staged, FATALITIES)
    labels, write = [], staging._written
    monkeypatch.setattr(staging, "_written", lambda df, label: labels.append(label) or write(df, label))

    def refreshed(year, keys):
        warehouse.replace_years(spark, loaded(spark, [(key, 2, year, None) for key in keys]), tables, FATALITIES, [year])
        found = staging.refresh(spark, tables, staged, FATALITIES)
        whole = dedup.stage(warehouse.read_table(spark, tables, FATALITIES), FATALITIES)
        assert content(staging.read_staged(spark, staged, FATALITIES)) == content(whole)
        return [int(folder.split("=")[1]) for folder in found]

    assert refreshed(2023, [f"k{i}" for i in range(100, 500)]) == [2020, 2021, 2022, 2023] and labels == []
    # A year that shares no key is still staged alone, and one that shares few keys of some years with these.
    assert refreshed(2024, [f"n{i}" for i in range(400)]) == [2024] and labels == ["changed_keys", "shared_keys"]
    assert refreshed(2024, ["k0", "n1"]) == [2020, 2021, 2022, 2024] and len(labels) == 4


def test_other_years_are_read_by_key_alone_and_behind_a_bloom_filter(spark, tmp_path, without_broadcast):
    tables = str(tmp_path / "loaded")
    rows = [(f"{year}-{i}", 1, year, None) for year in (2023, 2024) for i in range(200)]
    warehouse.append(spark, loaded(spark, rows), tables, FATALITIES)
    others = warehouse.read_table(spark, tables, FATALITIES).where(f"{LOAD_YEAR} = 2023")
    path = str(tmp_path / "keys")
    spark.createDataFrame([("2023-5",), ("2024-5",)], f"{staging._KEY} string").write.parquet(path)
    plan = plan_of(shared := staging.shared_keys(others, spark.read.parquet(path), FATALITIES))
    assert "ReadSchema: struct<fatality_id:string>" in plan and "might_contain" in plan and "Window" not in plan
    assert [tuple(r) for r in shared.collect()] == [("2023-5", 2023)]


def test_staging_scans_each_year_for_itself_and_sorts_no_load_columns(spark, tmp_path):
    tables = str(tmp_path / "tables")
    warehouse.create_table(spark, f"{tables}/events", EVENTS)
    rows = [(f"k{i}", (i + year) % 4, year, rev) for year in range(2020, 2024) for i in range(20) for rev in ("c1", "c2", None)]
    for load in (rows, rows[:50]):
        warehouse.append(spark, loaded(spark, load), f"{tables}/fatalities", FATALITIES)
    table = warehouse.read_table(spark, f"{tables}/fatalities", FATALITIES)
    by_year = warehouse.read_by_year(spark, f"{tables}/fatalities", FATALITIES)
    assert by_year.schema == table.schema and content(by_year) == content(table)
    assert warehouse.read_by_year(spark, f"{tables}/events", EVENTS).count() == 0
    for latest, order in ((False, []), (True, [F.desc_nulls_last(REVISION)])):
        staged = models.staging_views(spark, tables, latest_load_wins=latest).fatalities
        plan = plan_of(staged)
        assert plan.count("FileScan parquet") == 4 and plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") == 2
        sorts = [line for line in plan.splitlines() if "Sort [" in line or "Exchange" in line or "Window" in line]
        assert len(sorts) >= 5 and not any(c in line for line in sorts for c in (f"{LOAD_YEAR}#", "month_key#"))
        assert content(staged) == content(dedup.stage(table, FATALITIES, order))


def test_a_refresh_that_was_overtaken_is_an_error(spark, tmp_path, monkeypatch):
    tables, staged = str(tmp_path / "loaded"), str(tmp_path / "staged")
    warehouse.append(spark, loaded(spark, [("a", 1, 2024, None)]), tables, FATALITIES)
    write = versions.write_load

    def overtaken(spark, rows, root, by):
        load = write(spark, rows, root, by)
        versions.create(spark, root)
        return load

    monkeypatch.setattr(versions, "write_load", overtaken)
    with pytest.raises(versions.Conflict):
        staging.refresh(spark, tables, staged, FATALITIES)


def test_build_from_refreshed_tables(spark, tmp_path):
    tables, built = str(tmp_path / "tables"), str(tmp_path / "built")
    warehouse.create_table(spark, f"{tables}/events", EVENTS)
    for year in (2023, 2024):
        rows = [(f"{year}-{i}", 1, year, None) for i in range(3)]
        warehouse.replace_years(spark, loaded(spark, rows), f"{tables}/fatalities", FATALITIES, [year])
        found = models.build(spark, tables, built, staged_root=str(tmp_path / "staged"))
    assert content(found["fact_fatalities_by_month"]) == [(2023, 3, 3), (2024, 3, 3)]
    with pytest.raises(ValueError, match="one layout"):
        models.build(spark, tables, built, facts_by_date=True, buckets=4)


def test_views_of_the_catalog_are_there_for_other_sessions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("a", 2, 2023, "c1"), ("a", 1, 2024, "c2"), (None, 5, 2024, None), (None, 4, 2024, None), ("b", 1, 2023, None)]
    warehouse.append(spark, loaded(spark, rows), path, FATALITIES)
    table = warehouse.register_table(spark, "k9_fatalities", path, FATALITIES)
    catalog.create_partitioned(spark, "k9_events", EVENTS, str(tmp_path / "e"))
    try:
        models.create_views(spark, "k9_events", "k9_fatalities", prefix="k9_")
        other = spark.newSession()
        assert content(other.table("k9_stg_fatalities")) == content(dedup.stage(table, FATALITIES))
        assert other.table("k9_stg_events").schema.fieldNames() == EVENTS.columns
        # The view follows the table, and the latest load can win.
        warehouse.replace_years(spark, loaded(spark, [("c", 1, 2023, None)]), path, FATALITIES, [2023])
        warehouse.register_table(spark, "k9_fatalities", path, FATALITIES)
        assert {r.fatality_id for r in other.table("k9_stg_fatalities").collect()} == {"a", "c", None}
        models.create_views(spark, "k9_events", "k9_fatalities", prefix="k9_", latest_load_wins=True)
        assert content(other.table("k9_stg_fatalities")) == content(dedup.stage(table.sparkSession.table("k9_fatalities"), FATALITIES, [F.desc_nulls_last(REVISION)]))
    finally:
        for view in ("k9_stg_fatalities", "k9_stg_events", "k9_fatalities"):
            spark.sql(f"drop view if exists {view}")
        for table in ("k9_fatalities_loads", "k9_events"):
            spark.sql(f"drop table if exists {table}")


def _facts(spark):
    columns = {f.name: f.dataType for f in EVENTS.schema.fields}
    ids = spark.range(3000)
    key = F.when(F.col("id") % 100 != 0, F.col("id").cast("string")).alias("event_id")
    date = F.timestamp_seconds(F.lit(1_600_000_000) + F.xxhash64("id") % 50_000_000).alias("event_start_date")
    kind = F.concat(F.lit("type "), F.col("id") % 7).alias("event_type")
    rest = [F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in ("event_id", "event_start_date", "event_type")]
    events = facts.fact_events(ids.select(key, date, kind, *rest))
    # One event has a third of the fatalities.
    parent = F.when(F.col("id") % 3 == 0, F.lit("5")).otherwise((F.col("id") % 3500).cast("string")).alias("event_id")
    types = {f.name: f.dataType for f in FATALITIES.schema.fields}
    named = [F.col("id").cast("string").alias("fatality_id"), parent, F.when(F.col("id") % 2 == 0, "D").otherwise("I").alias("fatality_type")]
    rest = [F.lit(None).cast(t).alias(c) for c, t in types.items() if c not in ("fatality_id", "event_id", "fatality_type")]
    return events, facts.fact_fatalities(spark.range(9000).select(*named, *rest))


def test_the_join_of_bucketed_facts_has_no_exchange_below(spark, tmp_path, without_broadcast):
    events, fatalities = _facts(spark)
    try:
        one = catalog.write_bucketed(spark, events, "j1_events", str(tmp_path / "e"), "event_id", 8)
        two = catalog.write_bucketed(spark, fatalities, "j1_fatalities", str(tmp_path / "f"), "event_id", 8)
        mart = marts.fatality_type_by_event_type(one, two)
        plan = plan_of(mart)
        below = plan[plan.index("SortMergeJoin") :]
        assert "Exchange" not in below and below.count("Bucketed: true") == 2
        assert content(mart) == content(marts.fatality_type_by_event_type(events, fatalities))
        # The files can be attached to a catalog that does not know them.
        schema = one.schema
        spark.sql("drop table j1_events")
        again = catalog.attach_bucketed(spark, "j1_events", str(tmp_path / "e"), schema, "event_id", 8)
        plan = plan_of(marts.fatality_type_by_event_type(again, two))
        assert "Exchange" not in plan[plan.index("SortMergeJoin") :] and again.count() == 3000
    finally:
        for table in ("j1_events", "j1_fatalities"):
            spark.sql(f"drop table if exists {table}")


def test_build_with_buckets(spark, tmp_path):
    tables = str(tmp_path / "tables")
    for name, spec in (("events", EVENTS), ("fatalities", FATALITIES)):
        warehouse.create_table(spark, f"{tables}/{name}", spec)
    try:
        built = models.build(spark, tables, str(tmp_path / "built"), buckets=4, prefix="kb_")
        assert built["fact_fatality_type_by_event_type"].count() == 0 and spark.table("kb_fact_events").count() == 0
    finally:
        for table in ("kb_fact_events", "kb_fact_fatalities"):
            spark.sql(f"drop table if exists {table}")


def test_a_range_of_dates_reads_few_row_groups_of_ordered_facts(spark, tmp_path):
    events, _ = _facts(spark)
    start = datetime(2021, 1, 1), datetime(2021, 2, 1)

    def groups(path):
        """Row groups in all, and those whose statistics overlap the range."""
        total = hit = 0
        for file in path.glob("*.parquet"):
            meta = pq.ParquetFile(file).metadata
            column = meta.schema.names.index("event_start_date")
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(column).statistics
                total += 1
                hit += stats is None or not stats.has_min_max or (
                    stats.min.replace(tzinfo=None) < start[1] and stats.max.replace(tzinfo=None) >= start[0]
                )
        return total, hit

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    try:
        models.rebuild(spark, events.repartition(8), str(tmp_path / "plain"))
        ordered = models.rebuild(spark, events.repartition(8), str(tmp_path / "ordered"), "event_start_date")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    assert groups(tmp_path / "plain") == (8, 8)
    total, hit = groups(tmp_path / "ordered")
    assert total >= 7 and hit <= 2
    date = F.col("event_start_date")
    some = ordered.filter((date >= F.lit(start[0])) & (date < F.lit(start[1])))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(event_start_date", plan_of(some))
    assert some.count() > 0 and content(ordered) == content(events)


def test_checks_count_while_they_write(spark, tmp_path, monkeypatch):
    """One pass over each table fewer; values that are not listed take one over their columns."""
    tables = str(tmp_path / "tables")
    rows = [("a", 1, 2024, None), ("a", 2, 2024, None), (None, 1, 2024, None)]
    warehouse.create_table(spark, f"{tables}/events", EVENTS)
    odd = loaded(spark, rows).withColumn("fatality_type", F.lit("Z")).withColumn("fatality_sex", F.lit("M"))
    warehouse.append(spark, odd, f"{tables}/fatalities", FATALITIES)
    plans = []
    checks = quality.all_checks
    monkeypatch.setattr(quality, "all_checks", lambda *a: plans.append(plan_of(checks(*a))) or checks(*a))
    report = {(r.check, r.table, r.column): r.failures for r in models.check(spark, tables).collect()}
    assert report[("not_null", "stg_fatalities", "fatality_id")] == 1 and report[("not_null", "stg_events", "event_id")] == 0
    assert report[("accepted_values", "stg_fatalities", "fatality_type")] == 1
    assert report[("accepted_values", "stg_fatalities", "fatality_sex")] == 0 and len(report) == 9
    assert plans[0].count("FileScan parquet") == 5  # two passes over each table, and one over the odd column
    assert "ReadSchema: struct<fatality_type:string>" in plans[0]
