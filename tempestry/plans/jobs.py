"""The batch jobs: clean files, load years, backfill a range of years."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempestry.functions.calendar import month_key
from tempestry.operators.clean import clean, date_of
from tempestry.schemas import DATASETS, EVENTS, LOAD_YEAR
from tempestry.session import together
from tempestry.sources import csv_files, parquet_files, warehouse


def year_to_load(today: date) -> int:
    """The year before ``today``'s: a year's files are complete when it is over."""
    return today.year - 1


def clean_file(
    spark: SparkSession,
    source: str,
    target: str,
    dataset: str,
    files: int | None = None,
    multiline: bool = True,
    bad_rows: str = "error",
    **options,
) -> None:
    """[S1, S3, P1, P2, K1, K2] One CSV file or folder to cleaned Parquet, without a load year."""
    spec = DATASETS[dataset]
    rows = csv_files.read_csv(spark, source, spec, multiline=multiline, bad_rows=bad_rows)
    raw = parquet_files.spread(rows, files=files)
    parquet_files.write_parquet(clean(raw, spec, **options), target)


def cleaned_years(
    spark: SparkSession,
    source_root: str,
    dataset: str,
    years: Iterable[int],
    *,
    layout: str = "{name}",
    date_formats: Mapping[str, str] | None = None,
    rebase_century: bool = False,
    on_bad: str = "null",
    multiline: bool = True,
    same_header: bool = True,
    bad_rows: str = "error",
    revision: str | None = None,
    by_month: bool = False,
) -> DataFrame:
    """[S1, S2, P1, P2] The files of ``years`` as typed rows with their ``load_year`` and ``revision``.

    ``revision`` chooses among several files of a year (:func:`csv_files.year_files`),
    ``bad_rows`` says what to do with rows that do not fit their header
    (:func:`csv_files.read_csv`). ``date_formats`` maps a dataset's name to a pattern other than its own.
    ``rebase_century`` is for events, the ones with two-digit years.
    ``by_month`` lays the rows out for the loaded tables, by one shuffle of the
    raw text for which only the date is read before.
    """
    spec = DATASETS[dataset]
    files = csv_files.year_files(spark, source_root, spec, years, layout, revision)
    raw = csv_files.read_year_files(
        spark, files, spec, multiline=multiline, same_header=same_header, bad_rows=bad_rows
    )
    dates = {
        "date_format": (date_formats or {}).get(dataset),
        "century_from": LOAD_YEAR if rebase_century and spec is EVENTS else None,
    }
    text = next(F.col(source) for source, name, _ in spec.fields if name == spec.date)
    month = month_key(date_of(text, spec, **dates)) if by_month else None
    return clean(csv_files.deal_out(raw, files, month=month), spec, on_bad=on_bad, **dates)


def ingest(
    spark: SparkSession,
    source_root: str,
    lake_root: str,
    years: Iterable[int],
    datasets: Iterable[str] = tuple(DATASETS),
    **options,
) -> None:
    """[K3, K8] The files of ``years`` to cleaned Parquet, one job per dataset for all years.

    ``options`` are those of :func:`cleaned_years`.
    """
    years = list(years)

    def one(name: str) -> None:
        cleaned = cleaned_years(spark, source_root, name, years, **options)
        parquet_files.write_years(spark, cleaned, f"{lake_root}/{name}", years)

    together(spark, *(partial(one, name) for name in datasets))


def _store(
    spark: SparkSession,
    cleaned: Callable[[str], DataFrame],
    warehouse_root: str,
    years: list[int],
    mode: str,
    datasets: Iterable[str] = tuple(DATASETS),
) -> None:
    datasets = list(datasets)
    if mode not in ("replace", "append"):
        raise ValueError(f"mode must be 'replace' or 'append', not {mode!r}")

    def one(name: str) -> None:
        path, spec = f"{warehouse_root}/{name}", DATASETS[name]
        if mode == "append":
            warehouse.append(spark, inputs[name], path, spec)
        else:
            warehouse.replace_years(spark, inputs[name], path, spec, years)

    # All inputs are looked up before any table is written.
    inputs = {name: cleaned(name) for name in datasets}
    together(spark, *(partial(one, name) for name in datasets))


def load(
    spark: SparkSession,
    lake_root: str,
    warehouse_root: str,
    years: Iterable[int],
    mode: str = "replace",
    datasets: Iterable[str] = tuple(DATASETS),
) -> None:
    """[S4, S5, K4-K8] Cleaned Parquet of ``years`` into the loaded tables.

    A year that was not ingested has no folder and raises ``PATH_NOT_FOUND``
    before anything is written; one that was, without any row, is empty.
    """
    years = list(years)

    def cleaned(name: str) -> DataFrame:
        return parquet_files.read_years(spark, f"{lake_root}/{name}", DATASETS[name], years)

    _store(spark, cleaned, warehouse_root, years, mode, datasets)


def backfill(
    spark: SparkSession,
    source_root: str,
    warehouse_root: str,
    first: int,
    last: int,
    *,
    lake_root: str | None = None,
    mode: str = "replace",
    **options,
) -> None:
    """[K8] The files of ``first`` to ``last``, both included, into the loaded tables.

    With ``lake_root`` the cleaned rows are kept as Parquet too and loaded from
    there; without it they go straight to the tables, which saves writing and
    reading them once.
    """
    if first > last:
        raise ValueError(f"the first year, {first}, is after the last, {last}")
    years = list(range(first, last + 1))
    if lake_root:
        ingest(spark, source_root, lake_root, years, **options)
        load(spark, lake_root, warehouse_root, years, mode)
    else:
        cleaned = partial(cleaned_years, spark, source_root, years=years, by_month=True, **options)
        _store(spark, cleaned, warehouse_root, years, mode)
