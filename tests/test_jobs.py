"""The jobs from yearly files to marts, and the command line."""

import gzip
import threading
from datetime import date

import pytest
from pyspark.errors import AnalysisException

from tempestry import __main__ as command_line
from tempestry import registered
from tempestry.plans import jobs, models
from tempestry.schemas import EVENTS, FATALITIES
from tempestry.session import scratch_path, shuffle_partitions, together
from tempestry.sources import parquet_files, versions, warehouse

EVENT_HEADER = ",".join(EVENTS.raw_columns)
FATALITY_HEADER = ",".join(FATALITIES.raw_columns)


def write(root, kind, year, lines):
    path = root / f"StormEvents_{kind}-ftp_v1.0_d{year}_c20250101.csv.gz"
    with gzip.open(path, "wt") as file:
        file.write("\n".join(lines) + "\n")
    return str(path)


def event(key, day, kind="Hail", damage="1K"):
    return f"{key},TEXAS,{kind},{day} 10:00:00,{day} 11:00:00,0,0,0,0,{damage},2.5K,Public,,"


def fatality(key, parent, day, sex="M", kind="D"):
    return f"{key},{parent},{kind},{day} 00:00:00,41,{sex},Vehicle"


@pytest.fixture
def files(tmp_path):
    root = tmp_path / "files"
    root.mkdir()
    write(root, "details", 1999, [EVENT_HEADER, event(1, "28-APR-99"), event(2, "31-DEC-99", "Flood", "1B")])
    write(root, "fatalities", 1999, [FATALITY_HEADER, fatality("f1", 1, "28/04/1999"), fatality("f2", 2, "31/12/1999", "F", "I")])
    write(root, "details", 2000, [EVENT_HEADER, event(3, "02-FEB-00", "Flood", "?"), event(3, "02-FEB-00", "Flood", "?")])
    write(root, "fatalities", 2000, [FATALITY_HEADER, fatality("f3", 3, "02/13/2000"), fatality("f4", 9, "03/02/2000", "")])
    return root


def counts(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("with_lake", [True, False])
def test_from_files_to_marts(spark, files, tmp_path, capsys, with_lake):
    lake, tables, built = (str(tmp_path / name) for name in ("lake", "tables", "models"))
    options = ["--last", "2000", "--rebase-century", *(["--lake", lake] if with_lake else [])]
    command_line.main(["backfill", str(files), tables, "--first", "1999", *options])
    command_line.main(["backfill", str(files), tables, "--first", "2000", *options])
    assert (tmp_path / "lake" / "events" / "load_year=1999").exists() == with_lake
    command_line.main(["build", tables, built])
    read = lambda name: spark.read.parquet(f"{built}/{name}")
    assert counts(read("fact_fatality_type_by_event_type")) == [
        (1999, "Flood", "Indirect", 1), (1999, "Hail", "Direct", 1), (2000, "Flood", "Direct", 1),
    ]
    assert sorted(map(str, counts(read("fact_costliest_events")))) == sorted(
        map(str, [(1999, "Flood", 1_000_002_500), (1999, "Hail", 3_500), (2000, "Flood", None)])
    )
    assert counts(read("fact_fatalities_by_month")) == [(1999, 4, 1), (1999, 12, 1), (2000, 2, 1)]
    assert counts(read("fact_fatalities_by_sex")) == [(1999, "Female", 1), (1999, "Male", 1), (2000, "Unknown", 1)]
    assert read("fact_events").count() == 3 and read("fact_fatalities").count() == 4

    command_line.main(["answers", built, "--year", "1999"])
    printed = capsys.readouterr().out
    assert "costliest event types" in printed and "1000002500" in printed and "2000" not in printed.replace("1000002500", "")

    command_line.main(["check", tables])
    printed = capsys.readouterr().out
    assert "relationships" in printed and "warn" in printed
    report = {(r.check, r.column): r.failures for r in models.check(spark, tables).collect()}
    assert report[("relationships", "event_id")] == 1
    assert report[("not_null", "fatality_date")] == 1
    assert report[("unique", "event_id")] == 0


def test_yearly_loads_with_staged_tables_on_the_command_line(spark, files, tmp_path, capsys):
    tables, built, staged = (str(tmp_path / name) for name in ("tables", "models", "staged"))
    for year in ("1999", "2000"):
        command_line.main(["backfill", str(files), tables, "--first", year, "--last", year, "--rebase-century"])
        command_line.main(["build", tables, built, "--staged", staged, "--facts-by-date"])
    assert counts(spark.read.parquet(f"{built}/fact_fatalities_by_month")) == [(1999, 4, 1), (1999, 12, 1), (2000, 2, 1)]
    # The first year's staged folder was not written again.
    parts = versions.current(spark, f"{staged}/events").years()
    assert len(parts) == 2
    assert parts["load_year=1999"] != parts["load_year=2000"]
    command_line.main(["backfill", str(files), tables, "--first", "2000", "--last", "2000"])
    command_line.main(["vacuum", tables, "--keep", "1"])
    assert capsys.readouterr().out.split()[-4:] == ["events", "1", "fatalities", "1"]
    assert warehouse.read_table(spark, f"{tables}/events", EVENTS).count() == 4


def test_append_mode_doubles_until_staging(spark, files, tmp_path):
    lake, tables = str(tmp_path / "lake"), str(tmp_path / "tables")
    jobs.ingest(spark, str(files), lake, [1999, 2000])
    for _ in range(2):
        jobs.load(spark, lake, tables, [1999, 2000], mode="append")
    assert warehouse.read_table(spark, f"{tables}/events", EVENTS).count() == 8
    staged = models.staging_views(spark, tables)
    assert staged.events.count() == 3 and staged.fatalities.count() == 4
    assert spark.table("stg_events").count() == 3
    # Without the rebase, two-digit years are read as 20xx.
    assert {r.event_start_date.year for r in staged.events.collect()} == {2099, 2000}
    with pytest.raises(ValueError, match="mode"):
        jobs.load(spark, lake, tables, [1999], mode="merge")


def test_date_format_of_one_dataset(spark, files, tmp_path):
    lake = str(tmp_path / "lake")
    jobs.ingest(spark, str(files), lake, [2000], date_formats={"fatalities": "MM/dd/yyyy HH:mm:ss"})
    rows = parquet_files.read_years(spark, f"{lake}/fatalities", FATALITIES).collect()
    assert {r.fatality_id: r.fatality_date.date() for r in rows} == {"f3": date(2000, 2, 13), "f4": date(2000, 3, 2)}


def test_clean_one_file(spark, files, tmp_path):
    source = str(next(files.glob("*details*1999*")))
    target = str(tmp_path / "cleaned")
    command_line.main(["clean", source, target, "--dataset", "events", "--files", "4"])
    assert len(list((tmp_path / "cleaned").glob("*.parquet"))) <= 4
    back = parquet_files.read_parquet(spark, target, EVENTS.schema)
    assert sorted((r.event_id, r.damage_property) for r in back.collect()) == [("1", 1_000), ("2", 1_000_000_000)]


def test_year_to_load():
    assert jobs.year_to_load(date(2025, 1, 1)) == 2024


def test_shuffle_partitions_grow_with_the_data():
    assert [shuffle_partitions(gb) for gb in (0.1, 1_000, 100_000)] == [200, 4_000, 400_000]
    assert shuffle_partitions(100_000, most=40_000) == 40_000


def test_scratch_is_the_shared_folder_of_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(f"{shared}/")


@pytest.mark.parametrize("with_lake", [True, False])
def test_a_year_that_lost_its_rows_is_emptied(spark, files, tmp_path, with_lake):
    lake, tables = str(tmp_path / "lake") if with_lake else None, str(tmp_path / "tables")
    jobs.backfill(spark, str(files), tables, 1999, 2000, lake_root=lake)
    write(files, "fatalities", 2000, [FATALITY_HEADER])
    jobs.backfill(spark, str(files), tables, 2000, 2000, lake_root=lake)
    kept = warehouse.read_table(spark, f"{tables}/fatalities", FATALITIES)
    assert sorted(r.fatality_id for r in kept.collect()) == ["f1", "f2"]


def test_together_keeps_order_and_raises(spark):
    assert together(spark, lambda: spark.range(3).count(), lambda: "b") == [3, "b"]
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1, lambda: 1 / 0)


def test_a_missing_input_empties_no_year(spark, files, tmp_path):
    lake, tables = str(tmp_path / "lake"), str(tmp_path / "tables")
    jobs.ingest(spark, str(files), lake, [1999, 2000])
    jobs.load(spark, lake, tables, [1999, 2000])
    fresh = str(tmp_path / "fresh")
    jobs.ingest(spark, str(files), fresh, [2000])
    for mode in ("replace", "append"):
        with pytest.raises(AnalysisException, match="load_year=1999"):
            jobs.load(spark, fresh, tables, [1999, 2000], mode)
    assert warehouse.read_table(spark, f"{tables}/events", EVENTS).count() == 4
    assert warehouse.read_table(spark, f"{tables}/fatalities", FATALITIES).count() == 4
    with pytest.raises(AnalysisException, match="d2001"):
        jobs.backfill(spark, str(files), tables, 2000, 2001)
    with pytest.raises(ValueError, match="2001.*2000"):
        jobs.backfill(spark, str(files), tables, 2001, 2000)


def test_a_year_with_a_header_only_is_ingested_as_empty(spark, files, tmp_path):
    lake, tables = str(tmp_path / "lake"), str(tmp_path / "tables")
    write(files, "fatalities", 1999, [FATALITY_HEADER])
    jobs.ingest(spark, str(files), lake, [1999, 2000])
    for mode in ("replace", "append"):
        jobs.load(spark, lake, tables, [1999], mode)
    assert warehouse.read_table(spark, f"{tables}/fatalities", FATALITIES).count() == 0
    assert warehouse.read_table(spark, f"{tables}/events", EVENTS).count() == 4


def test_options_on_the_command_line(spark, files, tmp_path, capsys):
    tables, built = str(tmp_path / "tables"), str(tmp_path / "built")
    write(files, "fatalities", 2000, [FATALITY_HEADER, fatality("f3", 3, "02/13/2000"), fatality("f4", 9, "03/22/2000")])
    revised = files / "StormEvents_details-ftp_v1.0_d2000_c20260101.csv.gz"
    with gzip.open(revised, "wt") as file:
        file.write("\n".join([EVENT_HEADER, event(3, "02-FEB-00", "Flood", "9K"), event(4, "03-FEB-00", "Flood", "x"), "5,short"]))
    arguments = ["backfill", str(files), tables, "--first", "2000", "--last", "2000", "--date-format", "fatalities=MM/dd/yyyy HH:mm:ss"]
    with pytest.raises(ValueError, match="choose a revision"):
        command_line.main(arguments)
    command_line.main([*arguments, "--revision", "first", "--mode", "append"])
    with pytest.raises(Exception, match="row does not fit the header"):
        command_line.main([*arguments, "--revision", "latest", "--mode", "append"])
    with pytest.raises(Exception, match="not a damage amount"):
        command_line.main([*arguments, "--revision", "latest", "--mode", "append", "--bad-rows", "null", "--on-bad", "error"])
    command_line.main([*arguments, "--revision", "latest", "--mode", "append", "--bad-rows", "null"])
    dates = {r.fatality_date for r in warehouse.read_table(spark, f"{tables}/fatalities", FATALITIES).collect()}
    assert None not in dates and len(dates) == 2
    command_line.main(["build", tables, built, "--latest-load-wins", "--fix-year-month"])
    facts = {r.event_id: r for r in spark.read.parquet(f"{built}/fact_events").collect()}
    assert facts["3"].damage_property == 9_000 and facts["3"].event_start_year_month == "2000-2"
    assert models.staging_views(spark, tables).events.filter("event_id = '3'").first().damage_property is None
    command_line.main(["check", tables, "--latest-load-wins"])
    command_line.main(["answers", built, "-k", "1"])
    command_line.main(["rejects", str(revised)])
    assert "bad_rows" in capsys.readouterr().out


def test_registered_backfill_runs_the_load_job(spark, sf_dir, monkeypatch):
    """A year without ingested files stops the registered query, by the check of ``jobs.load``."""
    ingest = jobs.ingest
    monkeypatch.setattr(jobs, "ingest", lambda spark, files, lake, years, **options: ingest(spark, files, lake, years[1:], **options))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        registered.QUERIES["yearly_backfill"](spark, sf_dir).collect()
    monkeypatch.undo()
    loaded, load = [], jobs.load
    monkeypatch.setattr(jobs, "load", lambda *args, datasets, **options: loaded.extend(datasets) or load(*args, datasets=datasets, **options))
    assert registered.QUERIES["yearly_backfill"](spark, sf_dir).count() > 0
    assert sorted(loaded) == ["events", "fatalities"]


def test_registered_backfill_loads_both_tables_at_the_same_time(spark, sf_dir, monkeypatch):
    """One load waits for the other to begin, and neither would end if they came one by one."""
    both, load = threading.Barrier(2, timeout=60), jobs.load

    def meet(*args, **options):
        both.wait()
        load(*args, **options)

    monkeypatch.setattr(jobs, "load", meet)
    assert registered.QUERIES["yearly_backfill"](spark, sf_dir).count() > 0
