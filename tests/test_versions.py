"""Versions of loaded tables: published at once, whatever stops a load."""

from datetime import datetime
from functools import partial

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tempestry.schemas import FATALITIES, LOAD_YEAR
from tempestry.session import together
from tempestry.sources import versions, warehouse


@pytest.fixture
def rows(spark):
    def build(tag, years, per_year=4):
        """Rows of several months of each year, and one without date."""
        found = [
            (f"{tag}-{year}-{i}", None if i == 0 else datetime(year, i, 1), year) for year in years for i in range(per_year)
        ]
        df = spark.createDataFrame(found, f"fatality_id string, fatality_date timestamp, {LOAD_YEAR} int")
        others = [c for c in FATALITIES.columns if c not in df.columns]
        types = {f.name: f.dataType for f in FATALITIES.schema.fields}
        return df.select("*", *(F.lit(None).cast(types[c]).alias(c) for c in others))

    return build


def tags(spark, path, at=None):
    table = warehouse.read_table(spark, path, FATALITIES, at)
    return sorted({r.fatality_id.rsplit("-", 1)[0] for r in table.collect()})


def test_a_load_that_stops_between_folders_leaves_the_year_whole(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    warehouse.replace_years(spark, rows("old", [2023, 2024]), path, FATALITIES, [2023, 2024])
    before = sorted(r.fatality_id for r in warehouse.read_table(spark, path, FATALITIES).collect())
    # Some folders of the new load are there and others are not, as when a commit is cut off.
    write = versions.write_load

    def cut_off(spark, rows, root, partition_by):
        load, folder = write(spark, rows, root, partition_by)[0]
        months = sorted((tmp_path / "t" / "loads" / f"load_id={load}" / folder).iterdir())
        months[0].rename(tmp_path / "gone")
        raise OSError("the driver is gone")

    monkeypatch.setattr(versions, "write_load", cut_off)
    with pytest.raises(OSError):
        warehouse.replace_years(spark, rows("new", [2024]), path, FATALITIES, [2024])
    assert sorted(r.fatality_id for r in warehouse.read_table(spark, path, FATALITIES).collect()) == before
    monkeypatch.undo()
    # Or everything is written, but the pointer is not.
    monkeypatch.setattr(versions, "_publish", lambda *a: (_ for _ in ()).throw(OSError("no pointer")))
    with pytest.raises(OSError):
        warehouse.append(spark, rows("new", [2024]), path, FATALITIES)
    monkeypatch.undo()
    assert sorted(r.fatality_id for r in warehouse.read_table(spark, path, FATALITIES).collect()) == before
    warehouse.replace_years(spark, rows("new", [2024]), path, FATALITIES, [2024])
    assert tags(spark, path) == ["new-2024", "old-2023"]


def test_a_failing_job_publishes_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    warehouse.append(spark, rows("a", [2024]), path, FATALITIES)
    broken = rows("b", [2024]).withColumn("fatality_sex", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(PySparkException, match="broken"):
        warehouse.append(spark, broken, path, FATALITIES)
    assert versions.current(spark, path).number == 1 and tags(spark, path) == ["a-2024"]


def test_older_versions_can_be_read_until_they_are_removed(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    warehouse.create_table(spark, path, FATALITIES)
    for tag, years in (("a", [2023, 2024]), ("b", [2024]), ("c", [2024, 2025])):
        warehouse.replace_years(spark, rows(tag, years), path, FATALITIES, years)
    open_reader = warehouse.read_table(spark, path, FATALITIES, versions.version(spark, path, 3))
    assert [tags(spark, path, versions.version(spark, path, n)) for n in (1, 2, 3)] == [[], ["a-2023", "a-2024"], ["a-2023", "b-2024"]]
    assert versions.changed_years(versions.version(spark, path, 2), versions.current(spark, path)) == ["load_year=2024", "load_year=2025"]
    unpublished = versions.write_load(spark, rows("x", [2024]), path, ["load_year"])
    removed = versions.vacuum(spark, path, keep=1)
    assert len(removed) == 1 and unpublished[0][0] not in removed
    assert tags(spark, path) == ["a-2023", "c-2024", "c-2025"]
    with pytest.raises(ValueError, match="no version 3"):
        versions.version(spark, path, 3)
    with pytest.raises(Exception, match="does not exist"):
        open_reader.collect()
    assert versions.vacuum(spark, path, grace_hours=-1) == [unpublished[0][0]]


def test_loads_at_the_same_time_all_count(spark, tmp_path, rows):
    path, years = str(tmp_path / "t"), list(range(2015, 2023))
    together(
        spark,
        *(partial(warehouse.replace_years, spark, rows("a", [y]), path, FATALITIES, [y]) for y in years),
        partial(warehouse.append, spark, rows("b", [2030]), path, FATALITIES),
    )
    assert tags(spark, path) == sorted([*(f"a-{y}" for y in years), "b-2030"])
    assert versions.current(spark, path).number == len(years) + 1


def test_a_version_is_published_once(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create(spark, path)
    files = versions._Files(spark, path)
    with pytest.raises(versions.Conflict):
        versions._publish(files, path, 1, [("x", "load_year=2024")], {})
    assert versions.current(spark, path).parts == ()
    assert [n for n in files.names(f"{path}/pointers") if n.startswith("_")] == []


def test_a_table_that_is_not_there(spark, tmp_path):
    with pytest.raises(ValueError, match="no table"):
        warehouse.read_table(spark, str(tmp_path / "none"), FATALITIES)


def test_rows_without_year_are_loaded_and_registered(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = rows("a", [2024])
    warehouse.append(spark, df.withColumn(LOAD_YEAR, F.when(F.col("fatality_date").isNotNull(), F.col(LOAD_YEAR))), path, FATALITIES)
    warehouse.replace_years(spark, rows("b", [2024]), path, FATALITIES, [2024])
    try:
        table = warehouse.register_table(spark, "some_without_year", path, FATALITIES)
        for found in (table, warehouse.read_table(spark, path, FATALITIES)):
            assert sorted(r.fatality_id for r in found.collect()) == ["a-2024-0", *(f"b-2024-{i}" for i in range(4))]
    finally:
        spark.sql("drop view some_without_year")
        spark.sql("drop table some_without_year_loads")


def test_the_catalog_shows_published_loads_only(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    warehouse.replace_years(spark, rows("a", [2023, 2024]), path, FATALITIES, [2023, 2024])
    warehouse.register_table(spark, "versioned", path, FATALITIES)
    try:
        warehouse.replace_years(spark, rows("b", [2024]), path, FATALITIES, [2024])
        assert {r.fatality_id[:6] for r in spark.table("versioned").collect()} == {"a-2023", "a-2024"}
        table = warehouse.register_table(spark, "versioned", path, FATALITIES)
        assert {r.fatality_id[:6] for r in table.collect()} == {"a-2023", "b-2024"}
        plan = table.where("load_year = 2024")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan
    finally:
        spark.sql("drop view versioned")
        spark.sql("drop table versioned_loads")
